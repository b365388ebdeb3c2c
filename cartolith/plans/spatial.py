"""Spatial, raster and graph queries on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartolith.functions import geo
from cartolith.operators import graph, spatial
from cartolith.runtime import table

_RING = [(1000.0, 1000.0), (7000.0, 1500.0), (6500.0, 7000.0), (4000.0, 3500.0), (1500.0, 6500.0)]
_HOLE = [(3000.0, 1800.0), (4200.0, 1900.0), (3600.0, 2600.0)]


def _points(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 7919 % 8192).cast("double").alias("x"), (F.col("c_custkey") * 104729 % 8192).cast("double").alias("y"), "c_nationkey", "c_acctbal")


def _sites(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 6211 % 8192).cast("double").alias("x"), (F.col("s_suppkey") * 50021 % 8192).cast("double").alias("y"))


def _lit_ring(points):
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in points])


def pip_holes(spark, d):
    rings = F.array(_lit_ring(_RING), _lit_ring(_HOLE))
    return _points(spark, d).select("id", geo.in_polygon(rings, F.col("x"), F.col("y")).alias("inside"))


def nearest_within(spark, d):
    return spatial.nearest_within(_points(spark, d), _sites(spark, d), 400.0).withColumn("distance", F.round("distance", 6))


def box_overlap(spark, d):
    p = _points(spark, d).select("id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + 60).alias("x1"), (F.col("y") + 40).alias("y1"))
    s = _sites(spark, d).select("id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + 100).alias("x1"), (F.col("y") + 100).alias("y1"))
    return spatial.box_overlaps(p, s, 128.0)


def square_shapes(spark, d):
    """Area, perimeter and compactness of a rectangle for each part, and of its ring after corner cutting."""
    w, h = (F.col("p_size") + 1).cast("double"), (F.col("p_partkey") % 9 + 1).cast("double")
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((F.lit(0.0), F.lit(0.0)), (w, F.lit(0.0)), (w, h), (F.lit(0.0), h))])
    p = table(spark, d, "part").select("p_partkey", ring.alias("ring"))
    area, length = F.abs(geo.shoelace(F.col("ring"))) / 2, geo.perimeter(F.col("ring"))
    return p.select("p_partkey", F.round(area, 6).alias("area"), F.round(length, 6).alias("perimeter"), F.round(geo.compactness(area, length), 6).alias("compact"), F.round(F.abs(geo.shoelace(geo.chaikin(F.col("ring")))) / 2, 6).alias("smooth_area"))


def _edges(spark, d):
    """Four sides of a grid square for each part; the square's region is its label."""
    p = _pixels(spark, d)
    at = lambda r, c: (F.col("row") + r) * 100000 + F.col("col") + c
    sides = F.array(*[F.struct(at(*a).alias("va"), at(*b).alias("vb")) for a, b in (((0, 0), (0, 1)), ((0, 1), (1, 1)), ((1, 1), (1, 0)), ((1, 0), (0, 0)))])
    return p.select(F.col("label").alias("region"), "row", "col", F.inline(sides))


def _pixels(spark, d):
    return table(spark, d, "part").select(F.floor(F.col("p_partkey") / 64).cast("long").alias("row"), (F.col("p_partkey") % 64).alias("col"), (F.col("p_size") % 4).cast("int").alias("label"))


def dissolve_outline(spark, d):
    return spatial.outer_edges(_edges(spark, d)).groupBy("region").agg(F.count("*").alias("sides"))


def edge_adjacency(spark, d):
    return spatial.edge_adjacency(_edges(spark, d))


def majority3x3(spark, d):
    return spatial.majority(_pixels(spark, d), 5)


def dilate8(spark, d):
    return spatial.dilate(_pixels(spark, d), F.col("label") == 0).select("row", "col")


def raster_borders(spark, d):
    return spatial.shared_borders(_pixels(spark, d))


def arrival_owner(spark, d):
    """Owner of each pixel by the earliest arrival from eight centres; ties go to the lowest."""
    centres = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(k * 7 % 64)).alias("cx"), F.lit(float(k * 5 % 32)).alias("cy"), F.lit(1.0 + k % 3 / 4).alias("v")) for k in range(8)])
    t = lambda c: F.round(F.hypot(F.col("col") - c["cx"], F.col("row") - c["cy"]) / c["v"], 9)
    best = F.array_min(F.transform(centres, lambda c: F.struct(t(c).alias("t"), c["k"].alias("k"))))
    return _pixels(spark, d).select("row", "col", best["k"].alias("owner"), F.round(best["t"], 6).alias("t"))


def tile_pyramid_missing(spark, d):
    z = spark.range(0, 6).select(F.col("id").cast("int").alias("z"))
    side = F.expr("sequence(0, shiftleft(1, z) - 1)")
    tiles = z.select("z", F.explode(side).alias("x"), side.alias("ys")).select("z", "x", F.explode("ys").alias("y"))
    have = table(spark, d, "part").select((F.col("p_partkey") % 6).cast("int").alias("z"), (F.col("p_partkey") % 31).cast("int").alias("x"), (F.col("p_partkey") % 29).cast("int").alias("y"))
    return tiles.join(have, ["z", "x", "y"], "left_anti")


def components(spark, d):
    """Orders and parts that reach each other over lines; every line is an edge."""
    e = table(spark, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("a"), F.concat(F.lit("p"), "l_partkey").alias("b"))
    return graph.connected_components(e)


def dense_labels(spark, d):
    from pyspark.sql import Window

    p = table(spark, d, "part").select("p_size").distinct()
    return p.select("p_size", F.dense_rank().over(Window.orderBy("p_size")).alias("label"))


QUERIES = {f.__name__: f for f in (pip_holes, nearest_within, box_overlap, square_shapes, dissolve_outline, edge_adjacency, majority3x3, dilate8, raster_borders, arrival_owner, tile_pyramid_missing, components, dense_labels)}

_P = "p as (select c_custkey as id, (c_custkey * 7919 % 8192)::double as x, (c_custkey * 104729 % 8192)::double as y from customer)"
_S = "s as (select s_suppkey as id, (s_suppkey * 6211 % 8192)::double as x, (s_suppkey * 50021 % 8192)::double as y from supplier)"
_PIX = "pix as (select cast(p_partkey // 64 as bigint) as row, p_partkey % 64 as col, cast(p_size % 4 as int) as label from part)"
_SIDES = _PIX + ", e as (select label as region, unnest([row * 100000 + col, row * 100000 + col + 1, (row + 1) * 100000 + col, row * 100000 + col]) as lo, unnest([row * 100000 + col + 1, (row + 1) * 100000 + col + 1, (row + 1) * 100000 + col + 1, (row + 1) * 100000 + col]) as hi from pix)"
_cross = lambda ring: " + ".join(f"(case when ({ay} > y) <> ({by} > y) and x < ({bx} - {ax}) * (y - {ay}) / ({by} - {ay}) + {ax} then 1 else 0 end)" for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True) if ay != by)
SQL = {
    "pip_holes": f"with {_P} select id, ({_cross(_RING)}) % 2 = 1 and not ({_cross(_HOLE)}) % 2 = 1 as inside from p",
    "nearest_within": f"with {_P}, {_S}, j as (select p.id, s.id as target_id, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) as distance from p, s), r as (select *, row_number() over (partition by id order by distance, target_id) as r from j where distance <= 400) select id, target_id, round(distance, 6) as distance from r where r = 1",
    "box_overlap": f"with {_P}, {_S} select p.id as a_id, s.id as b_id from p, s where p.x <= s.x + 100 and s.x <= p.x + 60 and p.y <= s.y + 100 and s.y <= p.y + 40",
    "square_shapes": "with a as (select p_partkey, (p_size + 1)::double as w, (p_partkey % 9 + 1)::double as h from part) select p_partkey, round(w * h, 6) as area, round(2 * (w + h), 6) as perimeter, round(4 * pi() * w * h / (4 * (w + h) * (w + h)), 6) as compact, round(w * h * 0.875, 6) as smooth_area from a",
    "dissolve_outline": f"with {_SIDES}, n as (select region, lo, hi from e group by all having count(*) = 1) select region, count(*) as sides from n group by region",
    "edge_adjacency": f"with {_SIDES}, o as (select lo, hi, min(region) as a, max(region) as b from e group by lo, hi) select a, b, count(*) as shared from o where a < b group by a, b",
    "majority3x3": f"with {_PIX}, v as (select p.row, p.col, q.label, count(*) as n from pix p join pix q on q.row between p.row - 1 and p.row + 1 and q.col between p.col - 1 and p.col + 1 group by all having count(*) >= 5) select p.row, p.col, coalesce(v.label, p.label) as label from pix p left join v on v.row = p.row and v.col = p.col",
    "dilate8": f"with {_PIX} select p.row, p.col from pix p where exists (select 1 from pix q where q.label = 0 and q.row between p.row - 1 and p.row + 1 and q.col between p.col - 1 and p.col + 1)",
    "raster_borders": f"with {_PIX} select least(p.label, q.label) as a, greatest(p.label, q.label) as b, count(*) as length from pix p join pix q on p.label <> q.label and ((q.row = p.row and q.col = p.col + 1) or (q.col = p.col and q.row = p.row + 1)) group by 1, 2",
    "arrival_owner": f"with {_PIX}, c(k, cx, cy, v) as (values {', '.join(f'({k}, {k * 7 % 64}::double, {k * 5 % 32}::double, {1 + k % 3 / 4}::double)' for k in range(8))}), t as (select row, col, k, round(sqrt((col - cx) * (col - cx) + (row - cy) * (row - cy)) / v, 9) as t from pix, c), r as (select *, row_number() over (partition by row, col order by t, k) as r from t) select row, col, cast(k as int) as owner, round(t, 6) as t from r where r = 1",
    "tile_pyramid_missing": "with t as (select z::int as z, x::int as x, y::int as y from range(6) a(z), range(32) b(x), range(32) c(y) where x < (1 << z) and y < (1 << z)) select z, x, y from t where (z, x, y) not in (select ((p_partkey % 6)::int, (p_partkey % 31)::int, (p_partkey % 29)::int) from part)",
    "components": "with recursive u as (select 'o' || l_orderkey as a, 'p' || l_partkey as b from lineitem union select 'p' || l_partkey, 'o' || l_orderkey from lineitem), r(node, comp) using key (node) as (select distinct a, a from u union select u.b, min(r.comp) from r join u on u.a = r.node join recurring.r as old on old.node = u.b where r.comp < old.comp group by u.b) select node, comp as component from r",
    "dense_labels": "select p_size, cast(dense_rank() over (order by p_size) as int) as label from (select distinct p_size from part)",
}
