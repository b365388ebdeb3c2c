"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartolith.llm import bpe, decontaminate, exact, linear, minhash
from cartolith.llm.queries.tokens import TOKENIZER
from cartolith.runtime import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from all labelled rows among docs, within its bound."""
    weights = linear.fit_quality(docs, table(spark, sf_dir, "labels"))
    return linear.keep_quality(docs, weights)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of near duplicates: shingle sets with a similarity of 0.8 or more."""
    return minhash.drop_near(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every kept document."""
    return bpe.digests(docs, TOKENIZER)


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("BPE encoding and decoding", encode)]
#: The classifier's training and the tokenizer are not SQL; the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
