"""Small inputs on which earlier versions differed from the SQL, stopped, or made far too many rows."""

import math

from pyspark.sql import functions as F

from cartolith.operators import graph, layers, rasters
from cartolith.plans import registry
from tests.oracle import TABLES, rows_of_spark, rows_of_sql

FOLDER = "/root/testdata/sf0.001"


def test_ways_of_so_many_steps(spark):
    """A cheap way of four edges beside a dear one of one edge."""
    edges = spark.createDataFrame([(k, k + 1, 1) for k in range(1, 5)] + [(1, 5, 9)], "a long, b long, w long")
    seeds = spark.createDataFrame([(1, 1)], "node long, owner int")
    costs = lambda **k: {r.node: r.cost for r in graph.cheapest(edges, seeds, **k).collect()}
    assert costs(steps=1) == {1: 0, 2: 1, 5: 9}
    assert costs(steps=3) == {1: 0, 2: 1, 3: 2, 4: 3, 5: 9}
    assert costs(steps=4) == costs() == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}


def _folder(spark, tmp_path, **tables):
    """A data folder of other tables beside those of FOLDER."""
    for name in TABLES:
        if name not in tables:
            (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
            continue
        tables[name](spark.read.parquet(f"{FOLDER}/{name}.parquet")).coalesce(1).write.parquet(f"{tmp_path}/{name}.d")
        (found,) = (tmp_path / f"{name}.d").glob("*.parquet")
        found.rename(tmp_path / f"{name}.parquet")
    return str(tmp_path)


def _as_sql(spark, name, folder):
    got, want = rows_of_spark(registry.QUERIES[name](spark, folder)), rows_of_sql(registry.SQL[name], folder)
    assert want[1]
    assert got == want


def test_masks_end_at_the_frame(spark, tmp_path):
    """A cell that reaches beyond the last row of the raster (supplier 110)."""
    _as_sql(spark, "cell_masks", _folder(spark, tmp_path, supplier=lambda df: df.limit(2).withColumn("s_suppkey", F.lit(109).cast("long") + F.col("s_suppkey") % 2)))


def _copies(spark, tmp_path, times=6):
    """Customers, suppliers and parts repeated with shifted keys that stand for the same places and shapes."""
    again = lambda key, shift: lambda df: df.crossJoin(df.sparkSession.range(times).withColumnRenamed("id", "_k")).withColumn(key, F.col(key) + F.col("_k") * shift).drop("_k")
    return _folder(spark, tmp_path, customer=again("c_custkey", 8192), supplier=again("s_suppkey", 3 * 7600 * 8192))


def _broadcasts(df):
    """Whether the plan, as made before anything ran, sends a table to all: what Spark expects of exploded rows is far too small."""
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_coast_distances_of_copies(spark, tmp_path):
    folder = _copies(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["coast_distances"](spark, folder))
    _as_sql(spark, "coast_distances", folder)


def test_coastal_cells_of_copies(spark, tmp_path):
    folder = _copies(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["coastal_cells"](spark, folder))
    _as_sql(spark, "coastal_cells", folder)


def _sparse(spark, tmp_path):
    """A raster with holes: parts of which every third is missing, and long stretches of one label."""
    return _folder(spark, tmp_path, part=lambda df: df.where("p_partkey % 3 <> 1").withColumn("p_size", F.when(F.col("p_partkey") % 200 < 120, F.lit(4)).otherwise(F.col("p_size")).cast("int")))


def test_distance_field_with_holes(spark, tmp_path):
    folder = _sparse(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["distance_field"](spark, folder))
    _as_sql(spark, "distance_field", folder)


def test_filled_labels_with_holes(spark, tmp_path):
    folder = _sparse(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["filled_labels"](spark, folder))
    _as_sql(spark, "filled_labels", folder)


def test_inner_land_with_holes(spark, tmp_path):
    folder = _sparse(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["inner_land"](spark, folder))
    _as_sql(spark, "inner_land", folder)


def test_mask_overlaps_of_copies(spark, tmp_path):
    """Masks of one place have all pixels in common, and meet each other's as often as there are copies."""
    folder = _copies(spark, tmp_path, 3)
    assert not _broadcasts(registry.QUERIES["mask_overlaps"](spark, folder))
    _as_sql(spark, "mask_overlaps", folder)


def _steps(df):
    """The rows that the steps of a plan gave when it ran."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            rows = p.metrics().get("numOutputRows")
            found += [rows.get().value()] if rows.isDefined() else []
            todo += [p.children().apply(k) for k in range(p.children().size())]
    return found


def test_snapped_places_of_copies(spark, tmp_path):
    folder = _copies(spark, tmp_path)
    assert not _broadcasts(registry.QUERIES["snapped_places"](spark, folder))
    _as_sql(spark, "snapped_places", folder)


def test_nearest_sides_of_copies(spark, tmp_path):
    """Points and sides of one place meet once: no step gives as many rows as pairs of copies."""
    folder = _copies(spark, tmp_path, 20)
    assert max(_steps(registry.QUERIES["nearest_sides"](spark, folder))) < 10_000
    _as_sql(spark, "nearest_sides", folder)


def test_nearest_sides_moves_points_once(spark, tmp_path):
    """Places meet sides, and points take over their place's result: two joins, and rounding below the second."""
    folder = _copies(spark, tmp_path, 3)
    plan = registry.QUERIES["nearest_sides"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2
    assert plan.index("Join ") < plan.index("round(")
    _as_sql(spark, "nearest_sides", folder)


def test_equally_near_sides(spark, tmp_path):
    """A place with two cells' slanted sides at one distance: the smaller side counts, as in the SQL."""
    folder = _folder(spark, tmp_path, customer=lambda df: df.sparkSession.read.parquet("/root/testdata/sf0.1/customer.parquet").where("c_custkey % 40 = 5"), supplier=lambda df: df.crossJoin(df.sparkSession.range(100).withColumnRenamed("id", "_k")).withColumn("s_suppkey", F.col("s_suppkey") + F.col("_k") * 100).drop("_k"))
    _as_sql(spark, "nearest_sides", folder)


def test_pick_cells_of_copies(spark, tmp_path):
    """No step gives more rows than there are points."""
    folder = _copies(spark, tmp_path, 40)
    assert max(_steps(registry.QUERIES["pick_cells"](spark, folder))) <= 40 * 150
    _as_sql(spark, "pick_cells", folder)


def test_points_in_cells_of_copies(spark, tmp_path):
    """No step gives more rows than the result has."""
    folder = _copies(spark, tmp_path, 40)
    df = registry.QUERIES["points_in_cells"](spark, folder)
    assert max(_steps(df)) <= df.count()
    _as_sql(spark, "points_in_cells", folder)


def test_province_cities_of_copies(spark, tmp_path):
    """No step gives more rows than there are cities."""
    folder = _copies(spark, tmp_path, 40)
    assert max(_steps(registry.QUERIES["province_cities"](spark, folder))) <= 40 * 150
    _as_sql(spark, "province_cities", folder)


def test_relaxed_centres_are_any_number(spark):
    """More than 10,000 centres, some far from all points and each other, against all distances."""
    at = lambda k: ((k * 6211 % 997) * 1.0, (k * 50021 % 991) * 1.0)
    centres = [(k, *at(k)) for k in range(10_100)] + [(20_000, 1e6, 1e6), (20_001, 1e6 + 9, 1e6)]
    points = [(k * 137 % 1009 + 0.5, k * 71 % 1013 + 0.5) for k in range(40)] * 2 + [(5e5, 5e5), (9e5, 9e5)]
    near = [min(((x - a) * (x - a) + (y - b) * (y - b), k) for k, a, b in centres)[1] for x, y in points]
    own = {k: [p for p, n in zip(points, near, strict=True) if n == k] for k in set(near)}
    want = {k: tuple(sum(v) / len(own[k]) for v in zip(*own[k], strict=True)) if k in own else (a, b) for k, a, b in centres}
    got = layers.relaxed(spark.createDataFrame(points, "x double, y double"), spark.createDataFrame(centres, "id long, x double, y double"), 1)
    assert {r.id: (r.x, r.y) for r in got.collect()} == want


def test_sight_lines_end_where_they_meet(spark):
    """Against plain Python; no step gives more rows than there are pixels, where ways are up to 300 long."""
    owner = {(r, c): 0 if r < 40 and c < 3 else (r * r + 7 * c) % 3 for r in range(300) for c in range(4) if (r, c) != (9, 2)}
    centres = {k: min(p for p, v in owner.items() if v == k) for k in set(owner.values())}

    def sees(p, most):
        (r0, c0), n = centres[owner[p]], max(abs(a - b) for a, b in zip(p, centres[owner[p]], strict=True))
        way = [(math.floor(r0 + (p[0] - r0) * k / n + 0.5), math.floor(c0 + (p[1] - c0) * k / n + 0.5)) for k in range(1, min(n, most + 1))]
        return next((owner[q] for q in way if q in owner and owner[q] != owner[p]), None)

    pixels = spark.createDataFrame([(*p, v) for p, v in owner.items()], "row int, col int, owner int")
    heads = spark.createDataFrame([(k, *p) for k, p in centres.items()], "owner int, row int, col int")
    for most in (None, 3, 45):
        df = rasters.first_foreign(pixels, heads, **({} if most is None else {"most": most}))
        assert max(_steps(df)) <= len(owner)
        assert {(r.row, r.col): r.sees for r in df.collect()} == {p: sees(p, most or 1000) for p in owner}


def test_thinned_lists_no_pairs(spark, monkeypatch):
    """Crowded points with copies: the result of throwing one by one, and nothing written that is larger than the points."""
    points = spark.range(1200).selectExpr("id", "double(id * 7919 % 400 % 37) as x", "double(id * 104729 % 400 % 41) as y")
    written = []
    monkeypatch.setattr(layers, "materialize", lambda df: (written.append(df.count()), df.localCheckpoint())[1])
    got = {r.id for r in layers.thinned(points, 9.0).collect()}
    stay = []
    for r in points.withColumn("h", F.xxhash64("id")).orderBy("h").collect():
        if all((r.x - s.x) ** 2 + (r.y - s.y) ** 2 >= 81 for s in stay):
            stay.append(r)
    assert got == {r.id for r in stay}
    assert max(written) <= 1200
