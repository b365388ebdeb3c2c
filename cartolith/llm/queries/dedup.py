"""Queries of the duplicate removers that have SQL or run on built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolith.llm.exact import exact_groups
from cartolith.llm.lines import dedup_lines
from cartolith.runtime import table


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = first_value(doc_id) over w as kept,
       text_sha256
from d window w as (partition by text_sha256 order by n desc, doc_id)
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


LINES_SQL = r"""
with l as (
  select doc_id, i, line, ('0x' || substr(md5(line), 1, 7))::bigint as h
  from (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) - 1 as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents))),
chosen as (
  select *, i > 0 and ((h * 1000003 + coalesce(lag(h) over w, 0)) % 2147483647 % 3 = 0 or line = lag(line) over w) as mark
  from l window w as (partition by doc_id order by i)),
runs as (
  select *, i - row_number() over (partition by doc_id, mark order by i) as run from chosen),
ends as (
  select *, mark and row_number() over (partition by doc_id, mark, run order by i) % 2 = 1 as is_end from runs),
placed as (
  select *, coalesce(sum(is_end::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as pos
  from ends),
parts as (
  select doc_id, pos, count(*) as n, string_agg(line, chr(10) order by i) as body from placed group by doc_id, pos),
judged as (
  select *, n >= 2 and regexp_matches(body, '[^\x20\x09-\x0D]')
            and row_number() over (partition by body, n >= 2 order by doc_id, pos) > 1 as gone
  from parts)
select doc_id, sum(n)::bigint as n_lines, coalesce(sum(n) filter (gone), 0)::bigint as n_removed,
       sha256(coalesce(string_agg(body, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""
