"""Joins of points, sides and polygons, and measures of rings, on polygons made from the driver's tables, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolith.functions import geo
from cartolith.operators import polygons as P
from cartolith.runtime import table

_OUTER = ((0, 0), (300, 0), (400, 150), (300, 300), (0, 300), (100, 150))
_HOLE = ((180, 120), (240, 120), (240, 180), (180, 180))
_LAND = ((0, 0), (30, 5), (10, 25))


def _ring(offsets: tuple, x: str, y: str, scale) -> F.Column:
    return F.array(*[F.struct((F.col(x) + scale * a).cast("double").alias("x"), (F.col(y) + scale * b).cast("double").alias("y")) for a, b in offsets])


def cells(spark: SparkSession, d: str) -> DataFrame:
    """A six-sided cell with a hole for each supplier."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(k.alias("id"), "s_nationkey", (k * 37 % 101).alias("ord"), (F.col("s_acctbal") < 0).alias("hidden"), (k * 6211 % 7600).alias("bx"), (k * 50021 % 7600).alias("by"), (1 + k % 3).alias("s"))
    return s.select("id", "s_nationkey", "ord", "hidden", F.array(_ring(_OUTER, "bx", "by", F.col("s")), _ring(_HOLE, "bx", "by", F.col("s"))).alias("rings"))


def places(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), (k * 7919 % 8192 + 0.5).cast("double").alias("x"), (k * 104729 % 8192 + 0.5).cast("double").alias("y"), F.col("c_acctbal").cast("double").alias("people"))


def islands(spark: SparkSession, d: str) -> DataFrame:
    """A triangle at each customer's place."""
    return places(spark, d).select("id", F.array(_ring(_LAND, "x", "y", F.lit(1))).alias("rings"))


def pick_cells(spark, d):
    return P.pick(places(spark, d), cells(spark, d), 400.0, hidden="hidden")


def points_in_cells(spark, d):
    return P.points_in_polygons(places(spark, d), cells(spark, d), 400.0)


def province_cities(spark, d):
    forced = table(spark, d, "nation").select((F.col("n_nationkey").cast("long") + 1).alias("province_id"), F.lit(1).cast("long").alias("city_id"))
    own = cells(spark, d)
    return P.cities_of(own, places(spark, d), 60.0, 400.0, forced.join(own.select(F.col("id").alias("province_id")), "province_id", "left_semi"))


def shared_borders_free(spark, d):
    """Rows of bricks, each row moved by 7 more: sides overlap without common nodes."""
    k = F.col("p_partkey") - 1
    b = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr("(p_partkey - 1) div 20").alias("r"), (k % 20).alias("i"))
    b = b.select("id", (F.col("i") * 30 + F.col("r") * 7 % 30).alias("x"), (F.col("r") * 10).alias("y"))
    ring = _ring(((0, 0), (30, 0), (30, 10), (0, 10)), "x", "y", F.lit(1))
    return P.shared_boundaries(b.select("id", F.array(ring).alias("rings")), 64, 3.0)


def _sides(spark, d):
    return P.segments(cells(spark, d)).select((F.col("id") * 100 + F.col("ring") * 10 + F.col("at")).alias("id"), "ax", "ay", "bx", "by")


def nearest_sides(spark, d):
    points = places(spark, d)
    n = P.nearest_of_places(points, _sides(spark, d), 80.0)
    return P.at_places(points, n.select("x", "y", F.round("distance", 6).alias("distance"), F.round("fx", 4).alias("fx"), F.round("fy", 4).alias("fy")))


def snapped_places(spark, d):
    p = P.snapped(places(spark, d).select("id", "x", "y"), _sides(spark, d), 40.0, 5.0, 2.0)
    return p.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "moved")


def coast_distances(spark, d):
    return P.boundary_distances(cells(spark, d), islands(spark, d), 20.0).select("a_id", "b_id", F.round("distance", 6).alias("distance"))


def coastal_cells(spark, d):
    """Cells with an island's shore within 10, and how many."""
    near = P.boundaries_near(cells(spark, d), islands(spark, d), 10.0)
    return near.select(F.col("a_id").alias("id"), F.col("n").alias("shores"), F.round("nearest", 6).alias("nearest"))


def pieces_in_holes(spark, d):
    k = F.col("o_orderkey")
    small = table(spark, d, "orders").select(F.concat(F.lit("o"), k).alias("id"), (k * 6211 % 7600 + 190.5).alias("x"), (k * 50021 % 7600 + 130.5).alias("y"))
    own = cells(spark, d).select(F.concat(F.lit("s"), "id").alias("id"), "rings").union(small.select("id", F.array(_ring(_LAND, "x", "y", F.lit(1)))))
    return P.in_holes_of_others(own, 300.0)


def filled_holes(spark, d):
    f = P.without_small_holes(cells(spark, d), 6000.0)
    return f.select("id", F.size("rings").alias("rings"), F.round(geo.polygon_area(F.col("rings"), lambda r: F.abs(geo.shoelace(r)) / 2), 3).alias("area"))


def group_centres(spark, d):
    c = P.centres(cells(spark, d).union(cells(spark, d).select("id", "s_nationkey", "ord", "hidden", F.transform("rings", F.reverse).alias("rings"))), "s_nationkey")
    return c.select("s_nationkey", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("area", 2).alias("area"))


def geodesic_areas(spark, d):
    k = F.col("s_suppkey")
    ring = F.array(*[F.struct((k % 300 - 150 + F.lit(a) / 400).alias("x"), (k * 7 % 160 - 80 + F.lit(b) / 400).alias("y")) for a, b in (*_OUTER, _OUTER[0])])
    return table(spark, d, "supplier").select("s_suppkey", F.round(geo.geodesic_area_km2(ring), 3).alias("km2"))


def band_crop(spark, d):
    """What two cuts leave of a cell between the rows 1000 and 5000."""
    r = cells(spark, d).select("id", geo.cut_below(geo.cut_below(F.get("rings", F.lit(0)), "y", 1000.0), "y", 5000.0, keep_above=False).alias("r"))
    return r.where(F.size("r") >= 3).select("id", F.round(F.abs(geo.shoelace(F.col("r"))) / 2, 3).alias("area")).where("area > 0")


def inner_points(spark, d):
    p = cells(spark, d).select("id", "rings", geo.inner_point(F.col("rings")).alias("p"))
    return p.select("id", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"), geo.in_polygon(F.col("rings"), F.col("p.x"), F.col("p.y")).alias("inside"))


def line_measures(spark, d):
    """The outline as an open line: sinuosity and deviation of its upper part, points after densifying and at equal steps."""
    line = cells(spark, d).select("id", F.slice(F.get("rings", F.lit(0)), 1, 4).alias("line"))
    c = geo.line_character(F.col("line"))
    return line.select("id", F.round(c["sinuosity"], 6).alias("sinuosity"), F.round(c["deviation"], 6).alias("deviation"), F.size(geo.densify(F.col("line"), 70.0)).alias("dense"), F.size(geo.along(F.col("line"), 70.0)).alias("samples"))


def neighbour_counts(spark, d):
    return P.neighbour_lists(shared_borders_free(spark, d).select("a", "b")).select("id", "n", F.array_join("neighbours", ",").alias("neighbours"))


def common_supplier_edges(spark, d):
    o = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.collect_set("l_partkey").alias("edge_ids"))
    return P.common_edges(o)


QUERIES = {f.__name__: f for f in (pick_cells, points_in_cells, province_cities, shared_borders_free, nearest_sides, snapped_places, coast_distances, coastal_cells, pieces_in_holes, filled_holes, group_centres, geodesic_areas, band_crop, inner_points, line_measures, neighbour_counts, common_supplier_edges)}

_edges = lambda ring, k: ", ".join(f"({k}, {i}, {ax}, {ay}, {qx}, {qy})" for i, ((ax, ay), (qx, qy)) in enumerate(zip(ring, ring[1:] + ring[:1], strict=True)))
_S = f"""s as (select s_suppkey as id, s_nationkey, s_suppkey * 37 % 101 as ord, s_acctbal < 0 as hidden, s_suppkey * 6211 % 7600 as bx0, s_suppkey * 50021 % 7600 as by0, 1 + s_suppkey % 3 as sc from supplier),
o(ring, pos, ax, ay, qx, qy) as (values {_edges(_OUTER, 0)}, {_edges(_HOLE, 1)}),
e as (select id, ord, hidden, ring, pos, (bx0 + sc * o.ax)::double as ax, (by0 + sc * o.ay)::double as ay, (bx0 + sc * o.qx)::double as qx, (by0 + sc * o.qy)::double as qy from s, o)"""
_C = "c as (select c_custkey as id, c_custkey * 7919 % 8192 + 0.5::double as x, c_custkey * 104729 % 8192 + 0.5::double as y, c_acctbal::double as people from customer)"
_PIP = """r as (select c.id as point_id, e.id as polygon_id, any_value(ord) as ord, any_value(hidden) as hidden, ring, count(*) filter ((ay > y) <> (qy > y) and x < (qx - ax) * (y - ay) / nullif(qy - ay, 0) + ax) % 2 = 1 as inside from c, e group by c.id, e.id, ring),
hit as (select point_id, polygon_id, any_value(ord) as ord, any_value(hidden) as hidden from r group by all having bool_or(inside) filter (ring = 0) and not bool_or(inside) filter (ring = 1))""".replace("group by all having", "group by point_id, polygon_id having")
_T = "greatest(0, least(1, ((px - ax) * (qx - ax) + (py - ay) * (qy - ay)) / ((qx - ax) * (qx - ax) + (qy - ay) * (qy - ay))))"
_L = f"l as (select c.id, (c.x + o2.ax) as ax, (c.y + o2.ay) as ay, (c.x + o2.qx) as qx, (c.y + o2.qy) as qy from c, (values {_edges(_LAND, 0)}) o2(ring, pos, ax, ay, qx, qy))"


def _far(px, py, ax, ay, qx, qy):
    t = f"greatest(0, least(1, (({px} - {ax}) * ({qx} - {ax}) + ({py} - {ay}) * ({qy} - {ay})) / (({qx} - {ax}) * ({qx} - {ax}) + ({qy} - {ay}) * ({qy} - {ay}))))"
    return f"sqrt(power({px} - {ax} - {t} * ({qx} - {ax}), 2) + power({py} - {ay} - {t} * ({qy} - {ay}), 2))"


def _side(p, q, r):
    return f"(({q}x - {p}x) * ({r}y - {p}y) - ({q}y - {p}y) * ({r}x - {p}x))"


_GAP = f"""pairs as (select e.id as a_id, l.id as b_id, min(case when {_side('e.a', 'e.q', 'l.a')} * {_side('e.a', 'e.q', 'l.q')} < 0 and {_side('l.a', 'l.q', 'e.a')} * {_side('l.a', 'l.q', 'e.q')} < 0 then 0.0 else
least({_far('l.ax', 'l.ay', 'e.ax', 'e.ay', 'e.qx', 'e.qy')}, {_far('l.qx', 'l.qy', 'e.ax', 'e.ay', 'e.qx', 'e.qy')}, {_far('e.ax', 'e.ay', 'l.ax', 'l.ay', 'l.qx', 'l.qy')}, {_far('e.qx', 'e.qy', 'l.ax', 'l.ay', 'l.qx', 'l.qy')}) end) as distance
from e join l on l.ax between least(e.ax, e.qx) - 80 and greatest(e.ax, e.qx) + 80 and l.ay between least(e.ay, e.qy) - 80 and greatest(e.ay, e.qy) + 80 group by 1, 2)"""
_NEAR = f"""n as (select c.id as point_id, c.x, c.y, e.id * 100 + ring * 10 + pos as side_id, {_far('c.x', 'c.y', 'ax', 'ay', 'qx', 'qy')} as distance, {_T.replace('px', 'c.x').replace('py', 'c.y')} as t, ax, ay, qx, qy from c, e),
w as (select *, ax + t * (qx - ax) as fx, ay + t * (qy - ay) as fy, row_number() over (partition by point_id order by distance, side_id) as r from n)"""
_BRICK = "b as (select p_partkey as id, (p_partkey - 1) % 20 * 30 + (p_partkey - 1) // 20 * 7 % 30 as x, (p_partkey - 1) // 20 * 10 as y from part)"
_BORDER = """p as (select a.id as a, b.id as b, case when a.y = b.y then 10 else least(a.x, b.x) + 30 - greatest(a.x, b.x) end as length from b a join b on a.id < b.id and ((a.y = b.y and abs(a.x - b.x) = 30) or (abs(a.y - b.y) = 10 and abs(a.x - b.x) < 30)))"""
_A, _F = geo.WGS84_A, geo.WGS84_F
_q = lambda s: f"({1 - _F * (2 - _F)!r} * ({s} / (1 - {_F * (2 - _F)!r} * {s} * {s}) - ln((1 - {(_F * (2 - _F)) ** 0.5!r} * {s}) / (1 + {(_F * (2 - _F)) ** 0.5!r} * {s})) / {2 * (_F * (2 - _F)) ** 0.5!r}))"
SQL = {
    "points_in_cells": f"with {_S}, {_C}, {_PIP} select point_id, polygon_id from hit",
    "pick_cells": f"with {_S}, {_C}, {_PIP}, k as (select *, row_number() over (partition by point_id order by ord, polygon_id) as r from hit where not hidden) select c.id as point_id, k.polygon_id from c left join k on k.point_id = c.id and k.r = 1",
    "province_cities": f"""with {_S}, {_C}, {_PIP}, forced as (select n_nationkey + 1 as province_id, 1 as city_id from nation where n_nationkey + 1 in (select id from s)),
inside as (select polygon_id as province_id, point_id as city_id, row_number() over (partition by polygon_id order by people desc, point_id) as r from hit join c on c.id = point_id),
near as (select e.id as province_id, c.id as city_id, min({_far('c.x', 'c.y', 'ax', 'ay', 'qx', 'qy')}) as far from e, c where c.id not in (select point_id from hit) and e.id not in (select polygon_id from hit) group by 1, 2),
best as (select province_id, city_id, row_number() over (partition by province_id order by far, city_id) as r from near where far <= 60),
found as (select province_id, city_id, 'inside' as how from inside where r = 1 union all select province_id, city_id, 'nearest' from best where r = 1)
select province_id::bigint as province_id, city_id::bigint as city_id, how from found where province_id not in (select province_id from forced) union all select province_id::bigint, city_id::bigint, 'override' from forced""",
    "shared_borders_free": f"with {_BRICK}, {_BORDER} select a, b, length::double as length from p where length > 3",
    "nearest_sides": f"with {_S}, {_C}, {_NEAR} select point_id, round(distance, 6) as distance, round(fx, 4) as fx, round(fy, 4) as fy from w where r = 1 and distance <= 80",
    "snapped_places": f"with {_S}, {_C}, {_NEAR}, m as (select *, distance > 5 and distance <= 40 as moved from w where r = 1) select point_id as id, round(case when moved then fx + (x - fx) / distance * 2 else x end, 4) as x, round(case when moved then fy + (y - fy) / distance * 2 else y end, 4) as y, moved from m",
    "coast_distances": f"with {_S}, {_C}, {_L}, {_GAP} select a_id, b_id, round(distance, 6) as distance from pairs where distance <= 20",
    "coastal_cells": f"with {_S}, {_C}, {_L}, {_GAP} select a_id as id, count(*) as shores, round(min(distance), 6) as nearest from pairs where distance <= 10 group by a_id",
    "pieces_in_holes": f"""with {_S}, {_C}, mid as (select 's' || id as id, bx0 + sc * 200.0::double as x, by0 + sc * 150.0::double as y from s union all select 'o' || o_orderkey, o_orderkey * 6211 % 7600 + 190.5 + 40 / 3.0::double, o_orderkey * 50021 % 7600 + 140.5 from orders)
select distinct mid.id from mid, s where mid.id <> 's' || s.id and x > bx0 + sc * 180 and x < bx0 + sc * 240 and y > by0 + sc * 120 and y < by0 + sc * 180""",
    "filled_holes": f"with {_S} select id, (case when 3600 * sc * sc >= 6000 then 2 else 1 end)::int as rings, (90000 * sc * sc - case when 3600 * sc * sc >= 6000 then 3600 * sc * sc else 0 end)::double as area from s",
    "group_centres": f"with {_S} select s_nationkey, round(sum((bx0 + 200 * sc) * 90000.0 * sc * sc) / sum(90000.0 * sc * sc), 4)::double as x, round(sum((by0 + 150 * sc) * 90000.0 * sc * sc) / sum(90000.0 * sc * sc), 4)::double as y, (2 * sum(90000 * sc * sc))::double as area from s group by s_nationkey",
    "geodesic_areas": f"""with o(i, ax, ay, qx, qy) as (values {", ".join(f"({i}, {a}, {b}, {c}, {e})" for i, ((a, b), (c, e)) in enumerate(zip(_OUTER, _OUTER[1:] + _OUTER[:1], strict=True)))}),
p as (select s_suppkey, radians(s_suppkey % 300 - 150 + ax / 400.0::double) as l1, sin(radians(s_suppkey * 7 % 160 - 80 + ay / 400.0::double)) as s1, radians(s_suppkey % 300 - 150 + qx / 400.0::double) as l2, sin(radians(s_suppkey * 7 % 160 - 80 + qy / 400.0::double)) as s2 from supplier, o),
t as (select s_suppkey, l1, l2, tan(asin({_q('s1')} / pole) / 2) as t1, tan(asin({_q('s2')} / pole) / 2) as t2, pole from p, (select {_q('1.0::double')} as pole) z)
select s_suppkey, round(abs(sum(2 * atan2(tan((l2 - l1) / 2) * (t1 + t2), 1 + t1 * t2))) * {_A * _A / 2!r} * any_value(pole), 3) as km2 from t group by s_suppkey""",
    "band_crop": f"with {_S}, v as (select id, 300 * sc * (least(by0 + 300 * sc, 5000) - greatest(by0, 1000)) as area from s) select id, area::double as area from v where area > 0",
    "inner_points": f"with {_S} select id, (bx0 + sc * 320)::double as x, (by0 + sc * 150)::double as y, true as inside from s",
    "line_measures": f"with {_S}, g as (select id, sc, sqrt(100.0 * 100 + 150 * 150) * sc as leg from s) select id, round((300 * sc + 2 * leg) / (sc * sqrt(300.0 * 300 + 300 * 300)), 6) as sinuosity, round((300.0 * sc * 300 * sc) / (sc * sqrt(180000.0)), 6) as deviation, (1 + ceil(300 * sc / 70.0) + 2 * ceil(leg / 70))::int as dense, (floor((300 * sc + 2 * leg) / 70) + 2)::int as samples from g",
    "neighbour_counts": f"with {_BRICK}, {_BORDER}, u as (select a as id, b as n from p where length > 3 union select b, a from p where length > 3) select id, count(*)::int as n, string_agg(n::varchar, ',' order by n) as neighbours from u group by id",
    "common_supplier_edges": "with u as (select distinct l_suppkey as id, l_partkey as e from lineitem) select x.id as a, y.id as b, count(*) as shared from u x join u y on x.e = y.e and x.id < y.id group by 1, 2",
}
