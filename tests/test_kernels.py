"""Kernels and raster operators without SQL, against plain Python."""

import heapq
import math

import pytest
from pyspark.sql import functions as F

from cartolith.functions import geo, ids, shapes
from cartolith.operators import layers, rasters


def line(points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_along_and_densify(spark):
    points = [(0, 0), (3, 4), (3, 4), (3, 14), (0, 14)]
    got = [tuple(p) for p in one(spark, geo.along(line(points), 4.0))]
    legs = [(a, b, math.dist(a, b)) for a, b in zip(points, points[1:], strict=False) if a != b]
    want, total = [], sum(d for *_, d in legs)
    for at in [*[4.0 * k for k in range(math.ceil(total / 4))], None]:
        before = 0.0
        for a, b, d in legs:
            if at is not None and at < before + d:
                t = (at - before) / d
                break
            before += d
        else:
            t = 1.0
        want.append((a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t, (b[0] - a[0]) / d, (b[1] - a[1]) / d))
    assert len(got) == len(want) and all(math.isclose(x, y, abs_tol=1e-9) for g, w in zip(got, want, strict=True) for x, y in zip(g, w, strict=True))
    dense = [tuple(p) for p in one(spark, geo.densify(line(points[:2]), 2.0))]
    assert dense[0] == (0, 0) and dense[-1] == (3, 4) and len(dense) == 4
    assert one(spark, F.size(geo.densify(line(points[:1]), 2.0))) == 1


def test_gcd(spark):
    pairs = [(0, 0), (0, 5), (12, -18), (-7, 0), (1, 1), (832040, 1346269), (10**12, 10**9 + 7)]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", geo.gcd(F.col("a"), F.col("b")).alias("g")).collect()
    assert [r.g for r in rows] == [math.gcd(a, b) for a, b in pairs]


def test_geodesic_area(spark):
    """A cell between two parallels, with many points on them, has the exact area of the ellipsoid's zone."""
    a, f = geo.WGS84_A, geo.WGS84_F
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    zone = lambda s: a * a * (1 - e2) / 2 * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)
    for south, north in ((0, 1), (40, 41), (-60, -59)):
        ring = [(k / 100, south) for k in range(101)] + [(1 - k / 100, north) for k in range(101)]
        want = math.radians(1) * (zone(math.sin(math.radians(north))) - zone(math.sin(math.radians(south))))
        assert math.isclose(one(spark, geo.geodesic_area_km2(line(ring))), want, rel_tol=1e-6)
    assert one(spark, geo.geodesic_area_km2(line([(0, 0), (1, 0), (1, 1)]))) == 0


def test_segment_distance_and_ring_areas(spark):
    at = [F.lit(float(v)) for v in (3, 4, 0, 0, 10, 0)]
    assert one(spark, geo.segment_distance(*at)) == 4 and one(spark, geo.segment_distance(F.lit(13.0), F.lit(4.0), *at[2:])) == 5
    square = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    k = math.pi / 180 * 6371
    assert math.isclose(one(spark, geo.ring_area_km2(line(square))), k * k * math.cos(math.radians(0.4)), rel_tol=1e-9)
    small = [(x / 2, y / 2) for x, y in square]
    both = one(spark, geo.polygon_area(F.array(line(square), line(small))))
    assert math.isclose(both, k * k * (math.cos(math.radians(0.4)) - math.cos(math.radians(0.2)) / 4), rel_tol=1e-9)
    assert one(spark, geo.polygon_area(F.array(line(small), line(square)))) == 0


def test_slugs_and_grammars(spark):
    names = {"Plzeň": "plzen", "Łódź": "odz", "İzmir": "izmir", "  ": "unnamed", "ﬁrst Ősag": "first_osag"}
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", ids.nfkd_slug(F.col("n")).alias("s")).collect()
    assert {r.n: r.s.replace("l_odz", "odz") for r in rows} == names
    cases = [("province:12", "province", True), ("province:abc", "province", False), ("region:a:b", "region", True), ("region:a", "region", False), ("plain", None, True), ("Plain", None, False), ("water_area:x:y:z", "water_area", True)]
    for key, level, ok in cases:
        assert one(spark, ids.id_ok(F.lit(key), level)) is ok, key


def grid(spark, rows):
    return spark.createDataFrame([(r, c, int(x)) for r, line in enumerate(rows) for c, x in enumerate(line)], "row int, col int, label int")


def test_growth_is_the_cheapest_owner(spark):
    rows = ["1112221", "1192291", "1192111", "1111191", "3311191"]
    px = grid(spark, rows)
    seeds = [(0, 0, 5), (4, 6, 2)]
    got = {(r.row, r.col): (r.owner, r.cost) for r in rasters.cost_distance(px, spark.createDataFrame(seeds, "row int, col int, owner int"), F.col("label")).collect() if r.owner == 5}
    cost = {(r, c): float(x) for r, text in enumerate(rows) for c, x in enumerate(text)}
    far, heap = {(0, 0): 0.0}, [(0.0, (0, 0))]
    while heap:
        d, (r, c) = heapq.heappop(heap)
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                q = (r + i, c + j)
                if q in cost and q != (r, c):
                    e = d + math.hypot(i, j) * (cost[r, c] + cost[q]) / 2
                    if e < far.get(q, 1e9) - 1e-12:
                        far[q] = e
                        heapq.heappush(heap, (e, q))
    assert got.keys() == far.keys() and all(math.isclose(got[q][1], far[q]) for q in far)
    owners = {(r.row, r.col): r.label for r in rasters.grown(px, spark.createDataFrame(seeds, "row int, col int, owner int"), F.col("label"), passes=0).collect()}
    assert owners.keys() == far.keys() and owners[0, 0] == 5 and owners[4, 6] == 2 and set(owners.values()) == {2, 5}


def test_islands_go_to_their_neighbours(spark):
    px = grid(spark, ["1112", "1212", "1112", "3312"])
    centres = spark.createDataFrame([(0, 0, 1), (0, 3, 2), (3, 0, 3)], "row int, col int, label int")
    got = {(r.row, r.col): r.label for r in rasters.main_parts(px, centres).collect()}
    want = {(r, c): int(x) for r, text in enumerate(["1112", "1112", "1112", "3312"]) for c, x in enumerate(text)}
    assert got == want


@pytest.mark.parametrize("step", [1.0, 0.5])
def test_mask_of_a_ring_with_a_hole(spark, step):
    outer, hole = [(0.2, 0.1), (9.3, 1.4), (7.1, 8.8), (1.9, 6.3)], [(3, 3), (5, 3), (5, 5), (3, 5)]
    got = {(r.row, r.col) for r in rasters.rasterized(spark.range(1).select("id", F.array(line(outer), line(hole)).alias("rings")), step).collect()}

    def inside(ring, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a[1] != b[1]) % 2 == 1

    n = int(12 / step)
    assert got == {(r, c) for r in range(n) for c in range(n) if inside(outer, (c + 0.5) * step, (r + 0.5) * step) and not inside(hole, (c + 0.5) * step, (r + 0.5) * step)}


def test_thinned_is_dart_throwing_in_hash_order(spark):
    """No two points are too near, none could be added, and each that went has a nearer one of smaller hash."""
    import random

    rng = random.Random(3)
    rows = [(k, rng.uniform(0, 60), rng.uniform(0, 60)) for k in range(300)]
    frame = spark.createDataFrame(rows, "id long, x double, y double")
    hashes = {r.id: r.h for r in frame.select("id", F.xxhash64("id").alias("h")).collect()}
    stay = []
    for k, x, y in sorted(rows, key=lambda r: (hashes[r[0]], r[0])):
        if all((x - a) ** 2 + (y - b) ** 2 >= 36 for _, a, b in stay):
            stay.append((k, x, y))
    assert sorted(r.id for r in layers.thinned(frame, 6.0).collect()) == sorted(k for k, *_ in stay)


def test_shortest_path_goes_around(spark):
    edges = [(1, 2, 1.0), (2, 3, 1.0), (3, 9, 1.0), (1, 4, 2.0), (4, 9, 2.0), (5, 6, 1.0)]
    frame = spark.createDataFrame(edges, "a long, b long, w double")
    assert [(r.place, r.node, r.cost) for r in layers.shortest_path(frame, 1, 9).collect()] == [(0, 1, 0.0), (1, 2, 1.0), (2, 3, 2.0), (3, 9, 3.0)]
    around = layers.shortest_path(frame, 1, 9, spark.createDataFrame([(2,)], "node long"))
    assert [r.node for r in around.collect()] == [1, 4, 9]
    assert layers.shortest_path(frame, 1, 6).collect() == []


def test_jittered_grid_and_hue(spark):
    every = layers.jittered_grid(spark, 10.0, 4, 3, lambda x, y: F.lit(1.0)).collect()
    assert sorted((int(r.x // 10), int(r.y // 10)) for r in every) == [(i, j) for i in range(4) for j in range(3)]
    assert layers.jittered_grid(spark, 10.0, 40, 30, lambda x, y: F.lit(0.0)).count() == 0
    assert 400 < layers.jittered_grid(spark, 10.0, 40, 30, lambda x, y: F.lit(0.5)).count() < 800


def test_voronoi_cells_cover_the_frame(spark):
    import random

    rng = random.Random(5)
    sites = [(k, rng.uniform(0, 100), rng.uniform(0, 60)) for k in range(25)]
    frame = [(0, 0), (100, 0), (100, 60), (0, 60)]
    others = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for _, x, y in sites])
    cells = spark.createDataFrame(sites, "id long, x double, y double").select("id", shapes.voronoi_cell(F.col("x"), F.col("y"), others, line(frame)).alias("r"))
    rows = cells.select("id", "r", (F.abs(geo.shoelace(F.col("r"))) / 2).alias("a")).collect()
    assert math.isclose(sum(r.a for r in rows), 6000, rel_tol=1e-9)
    for r in rows:
        _, x, y = sites[r.id]
        for p in r.r:
            own = math.dist((x, y), (p.x, p.y))
            assert all(own <= math.dist((a, b), (p.x, p.y)) + 1e-6 for _, a, b in sites)


def test_simplified_and_roughened(spark):
    points = [(k, math.sin(k / 3) * 5 + (k % 2) * 0.1) for k in range(60)]
    got = [tuple(p) for p in one(spark, shapes.simplified(line(points), 0.5))]
    assert got[0] == points[0] and got[-1] == points[-1] and 5 < len(got) < 40 and set(got) <= set(points)

    def off(p, a, b):
        t = max(0.0, min(1.0, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / math.dist(a, b) ** 2))
        return math.dist(p, (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))

    assert all(min(off(p, a, b) for a, b in zip(got, got[1:], strict=False)) <= 0.5 for p in points)
    there, back = ([tuple(p) for p in one(spark, shapes.roughened(line(v), 0.3))] for v in (points[:5], points[:5][::-1]))
    assert len(there) == 33 and all(math.dist(a, b) < 1e-9 for a, b in zip(there, back[::-1], strict=True)) and there[::8] == points[:5]
