"""The repeated-passages query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartolith.llm.substrings import kept_digests
from cartolith.runtime import table


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(table(spark, sf_dir, "documents"))


SQL = r"""
with t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as (
  select doc_id, words, unnest(words) as word, generate_subscripts(words, 1) as i from t),
starts as (
  select doc_id, i, word, len(words) - i >= 19
         and row_number() over (partition by case when len(words) - i >= 19 then array_to_string(words[i:i + 19], ' ') end order by doc_id, i) > 1 as again
  from w),
judged as (
  select doc_id, i, word, bool_or(again) over (partition by doc_id order by i rows between 19 preceding and current row) as gone
  from starts)
select t.doc_id, len(any_value(t.words))::bigint as n_words, count(*) filter (gone) as n_removed,
       sha256(coalesce(string_agg(word, ' ' order by i) filter (not gone), '')) as kept_sha256
from t left join judged using (doc_id) group by t.doc_id
"""
