"""The licence query and the SQL of its base places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartolith.llm.licenses import scan_licenses
from cartolith.runtime import table


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")
