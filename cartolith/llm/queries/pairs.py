"""Queries of near duplicates and benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartolith.llm.decontaminate import find_leaks
from cartolith.llm.minhash import near_groups
from cartolith.runtime import table


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


NEAR_SQL = r"""
with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as shingle
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as i from t where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select p.a, p.b from pairs p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
  where 100 * common >= 85 * (x.n + y.n - common)),
reach as (
  select a as doc_id, b as other from links
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other)
select t.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles,
       least(t.doc_id, coalesce(min(r.other), t.doc_id)) as component_id,
       t.doc_id <= coalesce(min(r.other), t.doc_id) as kept
from t left join n using (doc_id) left join reach r using (doc_id) group by t.doc_id
"""
