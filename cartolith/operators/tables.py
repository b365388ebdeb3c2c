"""Integrity, ranking and merge operators on keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartolith.runtime import materialize


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that stand more than once; null and empty ones don't count."""
    return df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).groupBy(key).agg(F.count("*").alias("times")).where("times > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def reconcile(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row for each key that is on one side only, or has unequal fields (null equals null): key, finding."""
    a, b = left.select(key, F.struct(*fields).alias("l")), right.select(key, F.struct(*fields).alias("r"))
    said = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(~F.col("l").eqNullSafe(F.col("r")), "mismatch")
    return a.join(b, key, "full").select(key, said.alias("finding")).where("finding is not null")


def occurrence_suffix(df: DataFrame, key: str, order: list[Column | str], out: str = "new_id") -> DataFrame:
    """The first of equal keys keeps it, the next ones get _2, _3 and so on in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_n", n).withColumn(out, F.when(F.col("_n") == 1, F.col(key)).otherwise(F.concat_ws("_", key, "_n"))).drop("_n")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of old whose key isn't in new, and all of new; columns that one lacks are null."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def numbered(df: DataFrame, order: list[str], out: str = "place") -> DataFrame:
    """df with each row's place, from 1, in the order of columns that together differ for all rows.

    Rows are dealt to ranges of about equal counts and written; each range is numbered by itself behind the counts of
    those before it, so that no task holds all rows.
    """
    dealt = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # ranges are as many as partitions; their running sum is one small window
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(before), "_range").withColumn(out, F.col("_before") + F.col("_own")).drop("_range", "_before", "_own")


def allocate_ids(keys: DataFrame, registry: DataFrame, key: str, order: str) -> DataFrame:
    """Every key's number: its old one, or the next free ones in the order of first sight."""
    seen = keys.groupBy(key).agg(F.min(order).alias("first_seen"))
    joined = seen.join(registry, key, "left")
    top = registry.agg(F.coalesce(F.max("numeric_id"), F.lit(0)).alias("top"))
    fresh = numbered(joined.where("numeric_id is null").select(key, "first_seen"), ["first_seen", key]).crossJoin(F.broadcast(top))
    fresh = fresh.select(key, (F.col("top") + F.col("place")).alias("numeric_id"), F.lit(True).alias("is_new"))
    return joined.where("numeric_id is not null").select(key, "numeric_id", F.lit(False).alias("is_new")).union(fresh)


def longest_prefix(pieces: DataFrame, piece: str, targets: DataFrame, target: str) -> DataFrame:
    """Each piece with the longest target that it equals or extends by _..."""
    from cartolith.functions.ids import prefixes

    every = pieces.select(piece, F.explode(prefixes(F.col(piece))).alias(target))
    hit = every.join(targets.select(target).distinct(), target)
    return hit.groupBy(piece).agg(F.max_by(target, F.length(target)).alias(target))
