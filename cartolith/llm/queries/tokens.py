"""Queries of the tokenizer operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartolith.llm import bpe, pieces
from cartolith.runtime import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.count_pieces(table(spark, sf_dir, "documents"), TOKENIZER)
