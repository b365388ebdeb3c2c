"""Layer documents, GeoJSON, shapefiles and count tables as DataFrames."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolith.runtime import ship

RING = "array<array<double>>"
#: The columns under which vendors keep a boundary's attributes, in order of preference.
VENDOR_NAMES = {
    "iso": (("shapeISO", "boundaryISO", "ISO", "shapeGroup"), "UNK"),
    "name": (("shapeName", "boundaryName", "NAME_2"), "Unnamed Admin-2"),
    "admin1": (("ADM1_NAME", "shapeParent"), ""),
}
VENDOR_IDS = ("shapeID", "boundaryID")


def _read(spark: SparkSession, schema: str, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_layer(spark: SparkSession, path: str, container: str, item: str) -> DataFrame | None:
    """The items of a JSON document's list under container, of schema item; a missing file is None.

    A container that is absent or no list gives no rows.
    """
    docs = _read(spark, f"`{container}` string", path)
    if docs is None:
        return None
    listed = docs.where(F.col(container).startswith("["))
    return listed.select(F.inline(F.from_json(container, f"array<struct<{item}>>")))


def read_geojson(spark: SparkSession, path: str) -> DataFrame | None:
    """One row for each polygon of a FeatureCollection: feature (from 0), part, rings, props. A missing file is None.

    Multi-polygons become one row a part. Features of other kinds, or without geometry, give none.
    """
    docs = _read(spark, "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>", path)
    if docs is None:
        return None
    one = docs.select(F.posexplode("features").alias("feature", "f")).select("feature", "f.geometry", "f.properties")
    text = F.col("geometry.coordinates")
    parts = F.when(F.col("geometry.type") == "Polygon", F.array(F.from_json(text, f"array<{RING}>"))).when(F.col("geometry.type") == "MultiPolygon", F.from_json(text, f"array<array<{RING}>>"))
    out = one.select("feature", F.posexplode(parts).alias("part", "rings"), F.col("properties").alias("props"))
    return out.where(F.exists("rings", lambda r: F.size(r) >= 4))


def _first_of(props: Column, names: tuple[str, ...], otherwise: Column) -> Column:
    return F.coalesce(*[F.nullif(props[n], F.lit("")) for n in names], otherwise)


def vendor_columns(df: DataFrame, props: str = "props") -> DataFrame:
    """df with iso, name, admin1 and boundary_id from whichever vendor's column is there and not empty."""
    p = F.col(props)
    df = df.withColumns({k: _first_of(p, names, F.lit(otherwise)) for k, (names, otherwise) in VENDOR_NAMES.items()})
    return df.withColumn("boundary_id", _first_of(p, VENDOR_IDS, F.concat_ws("-", "iso", "name")))


def polygons(data: bytes) -> Iterator[tuple[int, list[list[list[float]]]]]:
    """Record number and rings for each polygon of a .shp file; other shapes are left out."""
    at = 100
    while at + 8 <= len(data):
        number, words = struct.unpack_from(">ii", data, at)
        body, at = at + 8, at + 8 + 2 * words
        if struct.unpack_from("<i", data, body)[0] not in (5, 15, 25):
            continue
        n_parts, n_points = struct.unpack_from("<ii", data, body + 36)
        starts = [*struct.unpack_from(f"<{n_parts}i", data, body + 44), n_points]
        flat = struct.unpack_from(f"<{2 * n_points}d", data, body + 44 + 4 * n_parts)
        yield number, [[[flat[2 * k], flat[2 * k + 1]] for k in range(a, b)] for a, b in zip(starts, starts[1:], strict=False)]


def attributes(data: bytes, encoding: str) -> Iterator[tuple[int, dict[str, str]]]:
    """Record number and attributes for each row of a .dbf file that is not marked as deleted."""
    rows, head, width = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
        at += 32
    for k in range(rows):
        if data[head + k * width : head + k * width + 1] == b"*":
            continue
        place, found = head + k * width + 1, {}
        for name, size in fields:
            found[name] = data[place : place + size].decode(encoding).strip()
            place += size
        yield k + 1, found


def read_shapefile(spark: SparkSession, stem: str, encoding: str = "latin-1") -> DataFrame:
    """record, rings, props of the shapefile at stem.shp and stem.dbf; props is null where a record has no row."""
    ship(spark)

    def parse(kind: str, columns: str, f) -> DataFrame:
        def run(frames):
            for frame in frames:
                for content in frame["content"]:
                    yield pd.DataFrame(list(f(content)), columns=["record", columns.split()[0]])

        return spark.read.format("binaryFile").load(f"{stem}.{kind}").select("content").mapInPandas(run, f"record long, {columns}")

    shapes = parse("shp", f"rings array<{RING}>", polygons)
    return shapes.join(parse("dbf", "props map<string,string>", lambda data: attributes(data, encoding)), "record", "left")


def read_boundaries(spark: SparkSession, stem: str) -> DataFrame:
    """The dataset at stem: the shapefile if there is one, else the GeoJSON; record, rings, props and vendor columns."""
    j = spark._jvm.org.apache.hadoop.fs.Path(f"{stem}.shp")
    if j.getFileSystem(spark._jsc.hadoopConfiguration()).exists(j):
        return vendor_columns(read_shapefile(spark, stem))
    found = read_geojson(spark, f"{stem}.geojson")
    if found is None:
        raise FileNotFoundError(f"neither {stem}.shp nor {stem}.geojson")
    return vendor_columns(found.select((F.col("feature").cast("long") + 1).alias("record"), "rings", "props"))


def read_counts(spark: SparkSession, path: str, key: str, count: str, **equal: str) -> DataFrame:
    """key and count (long) of a CSV with a header, with or without a byte order mark, where the named columns equal."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip('"') for c in df.columns])
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    return df.select(key, F.col(count).cast(T.LongType()).alias(count))


def required(df: DataFrame, key: str, value: object) -> DataFrame:
    """The one row with this key; running it fails when there are none or several."""
    found = df.where(F.col(key) == F.lit(value))
    n = found.agg(F.count("*").alias("_n")).select(F.when(F.col("_n") == 1, 1).otherwise(F.raise_error(F.format_string("%d rows with this key", "_n")).cast("int")).alias("_ok"))
    return n.join(found, F.col("_ok") == 1, "left").drop("_ok")
