"""Streams over files give what a plain replay gives."""

from collections import OrderedDict

from pyspark.sql import functions as F

from cartolith.functions import fields, ids
from cartolith.operators import graph
from cartolith.streaming import tiles


def _files(spark, tmp_path, df, n):
    """df as n files, read as a stream of one file a micro-batch."""
    for k in range(n):
        df.where(F.col("event_id") % n == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return tiles.queued(spark, str(tmp_path / "in"), ", ".join(f"{a} {b}" for a, b in df.dtypes), 1)


def _run(df, tmp_path, name):
    df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    return df.sparkSession.table(name)


def test_cache_and_queue(spark, tmp_path):
    base = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 2).alias("user"), F.timestamp_seconds(F.col("id")).alias("ts"), F.concat(F.lit("t"), F.col("id") * F.col("id") % 7).alias("tile"))
    got = _run(tiles.cached(_files(spark, tmp_path, base, 1), "user", 3), tmp_path, "cache").collect()
    want, held = {}, {0: OrderedDict(), 1: OrderedDict()}
    for r in base.orderBy("event_id").collect():
        h = held[r.user]
        hit, out = r.tile in h, None
        h[r.tile] = 1
        h.move_to_end(r.tile)
        if len(h) > 3:
            out = h.popitem(last=False)[0]
        want[r.event_id] = (r.user, r.tile, hit, out)
    assert {r.event_id: (r.user, r.tile, r.hit, r.evicted) for r in got} == want
    assert any(r.hit for r in got) and any(r.evicted for r in got)


def test_queue_takes_each_file_once(spark, tmp_path):
    base = spark.range(12).select(F.col("id").alias("event_id"))
    stream = _files(spark, tmp_path, base, 3)
    sizes = []
    stream.writeStream.foreachBatch(lambda b, _: sizes.append(b.count())).option("checkpointLocation", str(tmp_path / "q")).trigger(availableNow=True).start().awaitTermination(120)
    assert sizes == [4, 4, 4]


def test_levels(spark, tmp_path):
    exact = [3.0, 3.6, 3.66, 3.4, 3.3, 9.0, 7.5, -2.0]
    base = spark.createDataFrame([(k, 1, k, x) for k, x in enumerate(exact)], "event_id long, user int, s long, lod double").select("event_id", "user", F.timestamp_seconds("s").alias("ts"), "lod")
    got = {r.event_id: r.lod for r in _run(tiles.levels(_files(spark, tmp_path, base, 1), "user"), tmp_path, "levels").collect()}
    assert [got[k] for k in range(len(exact))] == [3, 3, 4, 4, 3, 7, 7, 0]


def test_debounced(spark, tmp_path):
    at = [0.0, 0.1, 0.15, 5.0, 5.3, 100.0]
    base = spark.createDataFrame([(k, "a", x) for k, x in enumerate(at)], "event_id long, user string, s double").select("event_id", "user", F.timestamp_seconds("s").alias("ts"))
    out = _run(tiles.debounced(_files(spark, tmp_path, base, 1), "user"), tmp_path, "bursts")
    assert sorted((r.event_id, r.n) for r in out.collect()) == [(2, 3), (3, 1), (4, 1)]


def test_warm_up(spark, tmp_path):
    base = spark.range(10).select(F.col("id").alias("event_id"), F.lit(3).alias("z"), (F.col("id") % 4).cast("int").alias("x"), F.lit(1).alias("y"))
    store = str(tmp_path / "store")
    for _ in range(2):
        tiles.warm_up(_files(spark, tmp_path, base, 2), store, str(tmp_path / "w")).awaitTermination(120)
    assert sorted(r.x for r in spark.read.parquet(store).collect()) == [0, 1, 2, 3]
    assert tiles.ticks(spark, 5).isStreaming


def test_names(spark):
    given = ["Entre RÃ\xados", "plain", "Ã", "€ Ã\xad", None, "Ñandú", ""]
    df = spark.createDataFrame([(x,) for x in given], "s string")
    assert [r[0] for r in df.select(ids.mended(F.col("s"))).collect()] == ["Entre Ríos", "plain", "Ã", "€ Ã\xad", None, "Ñandú", ""]
    names = spark.createDataFrame([("Галисия и щука",), ("Поле",), ("Объ ---",), ("!!",), (None,)], "s string")
    assert [r[0] for r in names.select(ids.cyrillic_slug(F.col("s"))).collect()] == ["galisiya_i_schuka", "ole", "b", "region", None]


def test_noise_against_plain_integers(spark):
    def plain(ix, iy, salt):
        v = (ix * 374761393 + iy * 668265263 + salt * 1442695041) % 2**32
        v = (v ^ v // 2**13) * 1274126177 % 2**32
        return (v ^ v // 2**16) / (2**32 - 1)

    df = spark.createDataFrame([(-5, 3), (0, 0), (70000, -81), (8192, 8192)], "x long, y long")
    for r in df.select("x", "y", fields.cell_noise(F.col("x"), F.col("y"), 17).alias("v")).collect():
        assert r.v == plain(r.x, r.y, 17)


def test_growth_ties_and_islands(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (8, 9), (3, 3)], "a long, b long")
    seeds = spark.createDataFrame([(1, 2), (5, 1)], "node long, owner int")
    assert sorted(tuple(r) for r in graph.grow(edges, seeds).collect()) == [(1, 2, 0), (2, 2, 1), (3, 1, 2), (4, 1, 1), (5, 1, 0)]
    costs = graph.cheapest(edges.withColumn("w", F.col("a")), seeds.where("owner = 2"))
    assert sorted(tuple(r) for r in costs.collect()) == [(1, 2, 0), (2, 2, 1), (3, 2, 3), (4, 2, 6), (5, 2, 10)]
    assert graph.grow(edges.limit(0), seeds).count() == 2
