"""Cuts, divisions and boxes of the cells' rings, and masks of pixels, on the driver's tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartolith.functions import geo, shapes
from cartolith.operators import rasters
from cartolith.plans import places, surfaces
from cartolith.runtime import table

_area = lambda r: F.abs(geo.shoelace(r)) / 2


def _outlines(spark, d):
    return places.cells(spark, d).select("id", F.get("rings", F.lit(0)).alias("r"))


def area_cuts(spark, d):
    """Cells cut by a level line so that a third of the area lies above it."""
    c = _outlines(spark, d).select("id", F.explode(F.array(shapes.area_cut(F.col("r"), 0.0, 1.0, F.lit(1 / 3)))).alias("c"))
    return c.select("id", F.round("c.c", 3).alias("c"), F.round(_area(F.col("c.one")), 2).alias("one"), F.round(_area(F.col("c.other")), 2).alias("other"))


def least_boxes(spark, d):
    b = _outlines(spark, d).select("id", shapes.least_box(F.slice("r", 1, 4)).alias("b"))
    return b.select("id", F.round("b.area", 3).alias("area"), F.round("b.aspect", 6).alias("aspect"))


def framed_cells(spark, d):
    """What a frame leaves of each cell."""
    frame = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((1000, 1000), (6000, 1000), (6000, 5000), (1000, 5000))])
    upper = F.array(*[F.struct((F.get("r", F.lit(k))["x"]).alias("x"), (F.get("r", F.lit(k))["y"]).alias("y")) for k in (0, 1)], *[F.struct(F.get("r", F.lit(j))["x"].alias("x"), F.get("r", F.lit(k))["y"].alias("y")) for j, k in ((1, 3), (0, 4))])
    c = _outlines(spark, d).select("id", shapes.clipped(upper, frame).alias("c"))
    return c.where(F.size("c") > 2).select("id", F.round(_area(F.col("c")), 3).alias("area")).where("area > 0")


def speed_profile(spark, d):
    knots = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((5, 1), (10, 3), (30, 2), (45, 8))])
    return table(spark, d, "part").select("p_partkey", F.round(shapes.interpolated(knots, F.col("p_size").cast("double")), 6).alias("v"))


def mask_overlaps(spark, d):
    """Pixels in both masks, in one, and in the other, for each two cells whose masks meet."""
    own = places.places(spark, d).select("id", F.floor("x").alias("bx"), F.floor("y").alias("by"))
    return rasters.mask_overlaps(own.select("id", F.array(places._ring(places._OUTER, "bx", "by", F.lit(3))).alias("rings")), 64.0)


def inner_land(spark, d):
    """Land pixels (label not 0) farther than 1.5 from any sea pixel: the land less a buffer around the sea."""
    f = rasters.signed_distance(surfaces.pixels(spark, d), F.col("label") != 0, 4.0)
    return f.where("d > 1.5").select("row", "col")


QUERIES = {f.__name__: f for f in (area_cuts, least_boxes, framed_cells, speed_profile, mask_overlaps, inner_land)}
SQL = {
    "area_cuts": f"with {places._S} select id, round(by0 + 200 * sc, 3)::double as c, round(30000.0 * sc * sc, 2)::double as one, round(60000.0 * sc * sc, 2)::double as other from s",
    "least_boxes": f"""with {places._S}, v(k, x, y) as (values (0, 0, 0), (1, 300, 0), (2, 400, 150), (3, 300, 300)), t as (select a.k as a, b.k as b, (b.x - a.x) / sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) as ux, (b.y - a.y) / sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) as uy from v a, v b where a.k <> b.k),
w as (select max(x * ux + y * uy) - min(x * ux + y * uy) as u, max(y * ux - x * uy) - min(y * ux - x * uy) as v from t, v group by a, b), m as (select u * v as area, greatest(u, v) / least(u, v) as aspect from w order by round(u * v, 6), aspect limit 1)
select id, round(area * sc * sc, 3) as area, round(aspect, 6) as aspect from s, m""",
    "framed_cells": f"with {places._S}, v as (select id, greatest(0, least(bx0 + 300 * sc, 6000) - greatest(bx0, 1000)) * greatest(0, least(by0 + 300 * sc, 5000) - greatest(by0, 1000)) as area from s) select id, area::double as area from v where area > 0",
    "speed_profile": "select p_partkey, round(case when p_size <= 5 then 1 when p_size < 10 then 1 + 2 * (p_size - 5) / 5.0::double when p_size < 30 then 3 - (p_size - 10) / 20.0::double when p_size < 45 then 2 + 6 * (p_size - 30) / 15.0::double else 8 end, 6) as v from part",
    "mask_overlaps": f"""with {places._C}, g as (select id, floor(x) as bx0, floor(y) as by0, row, col, (row + 0.5) * 64 as py, (col + 0.5) * 64 as px from c, range(0, 16) a(r), range(0, 21) b(k), lateral (select floor(y / 64)::int + r as row, floor(x / 64)::int + k as col) l),
r as (select g.id, row, col from g, (values {places._edges(places._OUTER, 0)}) o(ring, pos, ax, ay, qx, qy) group by g.id, row, col
having count(*) filter ((by0 + 3 * ay > py) <> (by0 + 3 * qy > py) and px < (qx - ax) * (py - by0 - 3 * ay) / nullif(qy - ay, 0)::double + bx0 + 3 * ax) % 2 = 1), n as (select id, count(*) as n from r group by id),
b as (select x.id as a, y.id as b, count(*) as common from r x join r y on x.row = y.row and x.col = y.col and x.id < y.id group by 1, 2)
select b.a, b.b, common, p.n + q.n - 2 * common as different from b join n p on p.id = b.a join n q on q.id = b.b""",
    "inner_land": f"with {surfaces._PIX} select p.row, p.col from pix p where label <> 0 and not exists (select 1 from pix q where q.label = 0 and (p.row - q.row) * (p.row - q.row) + (p.col - q.col) * (p.col - q.col) <= 2.25)",
}
