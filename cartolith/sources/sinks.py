"""Documents, tables, tile pyramids and gated releases."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that only matter to a renderer.
RENDERING = ("rings", "brd_open", "color")
BLOCK = 8000


def write_document(df: DataFrame, path: str, container: str, order: str, **meta: object) -> None:
    """One JSON document with meta and the ordered rows under container, as the one file of the folder path.

    Rows are sorted and written as lines in parallel; the driver then joins the parts by copying streams, so that no
    task and no program holds the document.
    """
    spark, (head, tail) = df.sparkSession, _frame(container, meta)
    jvm = spark._jvm
    as_path, conf = jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    staging = f"{path}-{uuid.uuid4().hex}"
    df.orderBy(order).select(F.concat(F.lit(","), F.to_json(F.struct(*df.columns))).alias("value")).write.option("lineSep", "\n").text(staging)
    fs = as_path(path).getFileSystem(conf)
    fs.delete(as_path(path), True)
    out = fs.create(as_path(f"{path}/part-00000.txt"))
    out.write(head.encode())
    first = True
    for part in sorted(str(f.getPath()) for f in fs.listStatus(as_path(staging)) if f.getPath().getName().startswith("part-") and f.getLen()):
        source = fs.open(as_path(part))
        if first:
            source.read()  # no comma before the first row
            first = False
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
        source.close()
    out.write(tail.encode())
    out.close()
    fs.delete(as_path(staging), True)


def _frame(container: str, meta: dict[str, object]) -> tuple[str, str]:
    """What stands before and behind the rows of a document."""
    before = json.dumps(meta | {container: []}, ensure_ascii=False)
    return before[:-2] + "\n", "]}\n"


def features(df: DataFrame) -> DataFrame:
    """df (rings and attributes) as one GeoJSON feature a row, without rows that have no ring and rendering columns."""
    properties = [c for c in df.columns if c not in RENDERING]
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates"))
    return df.where(F.size("rings") > 0).select(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")).alias("feature"))


def write_geojson(df: DataFrame, path: str) -> None:
    """One feature a line, in as many files as df has partitions: newline-delimited GeoJSON needs no single writer."""
    features(df).select(F.to_json("feature").alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """df sorted, with a header that starts with a byte order mark in each file."""
    first, *rest = df.columns
    df.orderBy(*order).select(F.col(first).alias(f"﻿{first}"), *rest).write.mode("overwrite").option("header", True).csv(path)


def full_tiles(pixels: DataFrame, value: str = "value") -> DataFrame:
    """z, x, y of the tiles whose pixels are not all the same; a flat tile needs no file."""
    return pixels.groupBy("z", "x", "y").agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where("lo < hi").select("z", "x", "y")


def write_pyramid(pixels: DataFrame, path: str, done: DataFrame | None = None) -> None:
    """Pixels (z, x, y, ...) of tiles that are not flat, by zoom; tiles in done (z, x, y) are not written again."""
    todo = full_tiles(pixels)
    if done is not None:
        todo = todo.join(done.select("z", "x", "y"), ["z", "x", "y"], "left_anti")
    pixels.join(todo, ["z", "x", "y"], "left_semi").write.mode("append").partitionBy("z").parquet(path)


def profile_hash(profile: Column) -> Column:
    """The first 16 hex digits of a profile's digest."""
    return F.substring(F.sha2(F.to_json(profile), 256), 1, 16)


def manifest(tiles: DataFrame, profile: Column) -> DataFrame:
    """profile_hash and counts (zoom to number of tiles) of a pyramid."""
    counts = tiles.groupBy("z").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("z", "count")))).alias("counts"))
    return counts.select(profile_hash(profile).alias("profile_hash"), "counts")


def raster_blocks(pixels: DataFrame, size: int = BLOCK) -> DataFrame:
    """Pixels (row, col, ...) with the block that holds them and their place in it."""
    block = lambda c: F.floor(F.col(c) / size).cast("int")
    return pixels.select("*", block("row").alias("block_row"), block("col").alias("block_col"), (F.col("row") % size).alias("in_row"), (F.col("col") % size).alias("in_col"))


def block_manifest(blocks: DataFrame) -> DataFrame:
    """One row a block: its origin and extent."""
    g = blocks.groupBy("block_row", "block_col")
    return g.agg(F.min("row").alias("row0"), F.min("col").alias("col0"), (F.max("in_row") + 1).alias("height"), (F.max("in_col") + 1).alias("width"))


#: Fixed value: the first bytes of a PNG file.
PNG = bytes([0x89, 0x50, 0x4E, 0x47, 0x0D, 0x0A, 0x1A, 0x0A])


def is_png(data: Column) -> Column:
    """Whether bytes begin and end as a PNG file does."""
    return (F.substring(F.hex(data), 1, 16) == PNG.hex().upper()) & F.hex(data).endswith("49454E44AE426082")


def tiles_digest(tiles: DataFrame) -> DataFrame:
    """z, count, digest of tiles (z, x, y, data): what a manifest says; the digest does not hang on the order."""
    own = F.xxhash64("x", "y", "data")
    return tiles.groupBy("z").agg(F.count("*").alias("count"), F.lower(F.hex(F.bit_xor(own))).alias("digest"))


def bundle_faults(bundles: dict[str, tuple[DataFrame, DataFrame]], readable: Callable[[Column], Column] | None = None) -> DataFrame:
    """bundle, z, expected, found wherever a bundle's tiles (z, x, y, data) are not what its manifest (z, count) says.

    A tile without data, or whose data readable() denies, counts as not found. Where the manifest has a digest column
    (tiles_digest), a zoom whose tiles have another digest counts as found -1.
    """
    good = F.length("data") > 0 if readable is None else (F.length("data") > 0) & readable(F.col("data"))

    def one(name: str, tiles: DataFrame, said: DataFrame) -> DataFrame:
        have = tiles_digest(tiles.where(good)).withColumnsRenamed({"count": "found", "digest": "own"})
        said = said if "digest" in said.columns else said.withColumn("digest", F.lit(None).cast("string"))
        both = said.select("z", F.col("count").alias("expected"), "digest").join(have, "z", "full").na.fill(0, ["expected", "found"])
        found = F.when((F.col("expected") == F.col("found")) & (F.col("digest") != F.col("own")), F.lit(-1)).otherwise(F.col("found"))
        return both.select(F.lit(name).alias("bundle"), "z", "expected", found.alias("found")).where("expected <> found")

    return reduce(DataFrame.union, [one(n, *b) for n, b in bundles.items()])


def publish(spark: SparkSession, bundles: dict[str, tuple[DataFrame, DataFrame]], path: str, readable: Callable[[Column], Column] | None = None) -> None:
    """Make the bundles the release at path, but only if all agree with their manifests.

    The whole release is written beside path and checked again as written. Then the old release is moved aside and the
    new one into its place; if that fails, the old one comes back. It is deleted last, so one of the two is always there.
    """
    bad = bundle_faults(bundles, readable).orderBy("bundle", "z").limit(5).collect()
    if bad:
        raise ValueError(f"not published: {[r.asDict() for r in bad]}")
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = as_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    new, old = f"{path}-new-{uuid.uuid4().hex}", f"{path}-old-{uuid.uuid4().hex}"
    try:
        for name, (tiles, _) in bundles.items():
            tiles.write.partitionBy("z").parquet(f"{new}/{name}")
        written = {n: (spark.read.schema(t.schema).parquet(f"{new}/{n}"), said) for n, (t, said) in bundles.items()}
        bad = bundle_faults(written, readable).limit(5).collect()
        if bad:
            raise OSError(f"not published, written otherwise: {[r.asDict() for r in bad]}")
        there = fs.exists(as_path(path))
        if there and not fs.rename(as_path(path), as_path(old)):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(as_path(new), as_path(path)):
            if there:
                fs.rename(as_path(old), as_path(path))
            raise OSError(f"could not move the release to {path}")
    finally:
        fs.delete(as_path(new), True)
    fs.delete(as_path(old), True)
