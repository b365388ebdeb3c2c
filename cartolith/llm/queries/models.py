"""Queries of the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolith.llm.linear import fit_quality, fit_toxicity, score_quality, score_toxicity
from cartolith.runtime import table


def held_out(id_col: str | Column) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False)) if isinstance(id_col, str) else id_col


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    w = fit_quality(docs, labels, usable=~held_out("id"))
    out = score_quality(docs, w)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, usable=~held_out("id"))
    out = score_toxicity(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("p_toxic").alias("score"), "severity", F.col("toxic").cast("int").alias("predicted"))
