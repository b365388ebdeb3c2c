"""Selections, queues, partitions, ways and seeds on the driver's tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartolith.functions import geo, scores
from cartolith.operators import checks, layers, rasters
from cartolith.plans import growth, places, surfaces
from cartolith.runtime import table


def changed_cells(spark, d):
    """Suppliers' phone-free cards with balances of customers of the same number where these are above 0."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"), "s_nationkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    return layers.set_properties(s, c, "id")


def painted_cells(spark, d):
    modes = {"wealth": lambda df: F.when(df["v"] < 0, "#a00000").when(df["v"] < 5000, "#c0c000").otherwise("#00a000"), "hue": lambda df: F.format_string("%.6f", scores.golden_hue(df["id"]))}
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"))
    return layers.painted(s, modes, "wealth").unionByName(layers.painted(s, modes, "hue"))


def whole_order_areas(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    w = layers.whole_areas(li, "l_orderkey", "l_quantity")
    return w.select("l_orderkey", "l_linenumber", "whole", scores.lake_tier(F.col("whole") * 3).alias("tier"))


def kept_partitions(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("cell"))
    m = table(spark, d, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_custkey").alias("cell"))
    return layers.kept_or_made(a, m, "g")


def review_queue(spark, d):
    c = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return layers.next_in_queue(c, ["c_acctbal", "id"])


def division_report(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.col("o_totalprice").cast("double").alias("a"), (F.sqrt(F.col("o_totalprice").cast("double")) * (4 + F.col("o_orderkey") % 5)).alias("outline"))
    whole = o.groupBy("o_custkey").agg((F.sum("a") + F.when(F.col("o_custkey") % 2 == 0, 5.0).otherwise(0.0)).alias("whole"))
    r = layers.partition_report(o, "o_custkey", "a", "outline", whole, 1.0)
    return r.select("o_custkey", "cells", *[F.round(c, 6).alias(c) for c in ("least", "most", "mean", "ratio", "least_compact", "mean_compact")], "coverage_ok")


def one_way_neighbours(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).distinct()
    return layers.asymmetric(p)


def enemy_cuts(spark, d):
    """Parts dealt to circles and rays; a circle's own pixels up to its nearest foreign one."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select((k % 5).alias("circle"), (k % 17).alias("ray"), k.alias("pixel"), (k * 7 % 101).cast("double").alias("d"), F.when(F.col("p_size") < 40, k % 5).otherwise(k % 5 + 1).alias("owner"))
    return layers.cut_by_enemies(p)


def cheapest_path_cost(spark, d):
    """The cost of the way from part 1 to each nation's part number, around parts of size 11; the way itself for one."""
    e = growth._links(spark, d)
    blocked = table(spark, d, "part").where("p_size = 11 and p_partkey > 30").select(F.col("p_partkey").alias("node"))
    return layers.shortest_path(e, 1, 29, blocked).select("place", "node", "cost")


def thinned_places(spark, d):
    return layers.thinned(places.places(spark, d), 150.0).select("id")


def seed_grid(spark, d):
    """Seeds by the chance that their distance from the first cell gives; hashes are Spark's own."""
    chance = lambda x, y: scores.seed_keep(F.hypot(x - 1000, y - 1000) / 8, F.lit(20.0), 6.0)
    return layers.jittered_grid(spark, 40.0, 50, 50, chance)


def relaxed_centres(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 6211 % 8192).cast("double").alias("x"), (F.col("s_suppkey") * 50021 % 8192).cast("double").alias("y"))
    r = layers.relaxed(places.places(spark, d), s, 2)
    return r.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def hairpins(spark, d):
    """Corners of the cells' outlines where the ring turns back by more than a right angle."""
    v = places.cells(spark, d).select("id", F.posexplode(F.get("rings", F.lit(0))).alias("at", "p")).select("id", "at", "p.x", "p.y")
    w = layers.ring_windows(v, "id", "at", ("x", "y"))
    dot = (F.col("x") - F.col("prev_x")) * (F.col("next_x") - F.col("x")) + (F.col("y") - F.col("prev_y")) * (F.col("next_y") - F.col("y"))
    return w.where(dot < 0).select("id", "at", dot.alias("dot"))


def small_cell_markers(spark, d):
    c = places.cells(spark, d).withColumn("area", geo.polygon_area(F.col("rings"), lambda r: F.abs(geo.shoelace(r)) / 2))
    m = layers.small_markers(c, "area", 200000.0)
    return m.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def content_tiles(spark, d):
    b = places.places(spark, d).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    return layers.tiles_with_content(5, tuple(b), 16384.0, spark)


def border_lines(spark, d):
    """Pixels beside another label, and those next to such ones."""
    p = surfaces.pixels(spark, d)
    b = rasters.border_pixels(p)
    return b.select("row", "col", "label")


def aliased_cells(spark, d):
    """Parts that stand for another one take its number and size, where there is such a part."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size")
    a = table(spark, d, "part").where("p_size > 40").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 3).alias("to"))
    return layers.remapped(p, a, "id", p, ("p_size",))


def marine_features(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", F.when(F.col("p_size") % 3 > 0, F.lit(" ")).otherwise(F.col("p_brand")).alias("name_en"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("label"))
    kinds = tuple(r[0] for r in table(spark, d, "part").select("p_type").distinct().orderBy("p_type").limit(2).collect())
    return layers.of_classes(p, "p_type", kinds, ("name_en", "label"), "?").select("p_partkey", "name")


def kept_islands(spark, d):
    """Customers as pieces: small balances go unless their name, nation or place protects them, or they are their nation's largest."""
    k = F.col("c_custkey")
    p = table(spark, d, "customer").select(k.alias("id"), F.concat(F.lit("Isle "), k % 97).alias("name"), F.col("c_nationkey").alias("country"), F.col("c_acctbal").cast("double").alias("area"), (k * 7919 % 360 - 180).alias("lon"), (k * 104729 % 180 - 90).alias("lat"))
    names = spark.createDataFrame([("ISLE 5",), (" isle 7 ",)], "name string")
    top = spark.createDataFrame([(3, 2), (4, 1)], "country long, n int")
    lon, lat = F.col("lon"), F.col("lat")
    kept = layers.island_filter(p, "area", 3000.0, lon.between(-90, -60) & lat.between(10, 28), 1000.0, names, (1, 2), lon.between(100, 140) & lat.between(-10, 10), top)
    return kept.select("id", "area")


def zone_figures(spark, d):
    """Bricks of 30 by 10 as atoms of zones by their size; their outlines from shared and outer sides."""
    b = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 5).alias("zone"), F.lit(300.0).alias("area"))
    inner = places.shared_borders_free(spark, d).select("a", "b", "length")
    return layers.zone_shapes(b, inner).select("zone", "atoms", "area", F.round("outline", 4).alias("outline"), F.round("compactness", 9).alias("compactness"))


def split_scores(spark, d):
    """How bad each label's rasters of 64 columns are as one side of a division."""
    g = table(spark, d, "part").groupBy("p_size").agg(F.count("*").alias("n"), F.sum("p_retailprice").cast("double").alias("v"))
    n = F.col("n").cast("double")
    q = layers.split_quality(n / 100, F.lit(0.4), n * 2, F.lit(100.0), (F.lit(0.5), n / 200), (F.lit(1.0), F.sqrt(n) / 20), (F.lit(90.0), n))
    return g.select("p_size", F.round(q, 6).alias("score"))


def scenario_faults(spark, d):
    s = table(spark, d, "orders").select(F.when(F.col("o_custkey") % 50 == 0, F.lit(" ")).otherwise(F.concat(F.lit("province:"), "o_custkey")).alias("province_id"), F.when(F.col("o_orderkey") % 9 == 0, F.lit('{"rings": [], "owner": "x"}')).otherwise(F.lit('{"owner": "y"}')).alias("raw"))
    p = table(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("province:"), "c_custkey").alias("id"))
    return checks.scenario_violations(s, p, ("rings", "geometry"))


def allowed_lines(spark, d):
    allowed = spark.createDataFrame([(1, "a"), (3, "b"), (4, "a")], "l_linenumber int, zone string").withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity")
    return layers.allocated(li, allowed, "l_linenumber").groupBy("zone").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


QUERIES = {f.__name__: f for f in (kept_islands, zone_figures, split_scores, scenario_faults, allowed_lines, changed_cells, painted_cells, whole_order_areas, kept_partitions, review_queue, division_report, one_way_neighbours, enemy_cuts, cheapest_path_cost, thinned_places, seed_grid, relaxed_centres, hairpins, small_cell_markers, content_tiles, border_lines, aliased_cells, marine_features)}

_LINKS = "l as (select p_partkey as a, p_partkey // 3 as b, 1 + p_size % 9 as w from part where p_size <> 13 union all select p_partkey, p_partkey // 5, 3 from part where p_size <> 13 and p_size % 4 = 0)"
SQL = {
    "kept_islands": """with p as (select c_custkey as id, 'isle ' || c_custkey % 97 as name, c_nationkey as country, c_acctbal::double as area, c_custkey * 7919 % 360 - 180 as lon, c_custkey * 104729 % 180 - 90 as lat from customer),
b as (select country, name, row_number() over (partition by country order by area desc, 'Isle ' || id % 97) as r from p)
select id, area from p where name in ('isle 5', 'isle 7') or country in (1, 2) or (lon between 100 and 140 and lat between -10 and 10) or (country, name) in (select country, name from b where (country = 3 and r <= 2) or (country = 4 and r <= 1))
or area >= case when lon between -90 and -60 and lat between 10 and 28 then 1000 else 3000 end""",
    "zone_figures": f"with {places._BRICK}, {places._BORDER}, z as (select p_partkey as id, p_size % 5 as zone from part), s as (select x.zone as za, y.zone as zb, length from p join z x on x.id = a join z y on y.id = b where length > 3 and x.zone <> y.zone), o as (select zone, sum(length) as outline from (select za as zone, length from s union all select zb, length from s) group by zone), g as (select zone, count(*) as atoms, 300.0::double * count(*) as area from z group by zone) select zone, atoms, area, coalesce(outline, 0)::double as outline, round(case when outline > 0 then 4 * pi() * area / (outline * outline) else 0 end, 9) as compactness from g left join o using (zone)",
    "split_scores": "with g as (select p_size, count(*)::double as n from part group by 1) select p_size, round(abs(n / 100 - 0.4::double) * 6 + n * 2 / 10 * 0.42::double + (1.5::double - n / 200) * 0.7::double + (greatest(0, 0.12::double - 1 / sqrt(90.0::double)) + greatest(0, 0.12::double - sqrt(n) / 20 / sqrt(n))) * 10, 6) as score from g",
    "scenario_faults": """with s as (select case when o_custkey % 50 = 0 then ' ' else 'province:' || o_custkey end as k, o_orderkey % 9 = 0 as bad from orders)
select k as key, 'empty_province_id' as rule from s where k = ' ' union all select k, 'forbidden_field' from s where bad union all select distinct k, 'unknown_province' from s where k not in (select 'province:' || c_custkey from customer where c_acctbal > 0) union all select k, 'duplicate_province_id' from s group by k having count(*) > 1""",
    "allowed_lines": "with a(n, zone) as (values (1, 'a'), (3, 'b'), (4, 'a')) select zone, count(*) as n, sum(l_quantity) as quantity from lineitem join a on a.n = l_linenumber group by zone",
    "changed_cells": "select s_suppkey as id, case when c_acctbal > 0 then c_acctbal else s_acctbal end as v, s_nationkey from supplier left join customer on c_custkey = s_suppkey",
    "painted_cells": "select s_suppkey as id, s_acctbal as v, case when s_acctbal < 0 then '#a00000' when s_acctbal < 5000 then '#c0c000' else '#00a000' end as color from supplier union all select s_suppkey, s_acctbal, printf('%.6f', s_suppkey * ((sqrt(5) - 1) / 2) - floor(s_suppkey * ((sqrt(5) - 1) / 2))) from supplier",
    "whole_order_areas": "with w as (select l_orderkey, sum(l_quantity) as whole from lineitem group by 1) select l_orderkey, l_linenumber, whole, case when whole * 3 >= 500 then 'large' when whole * 3 >= 15 then 'small' end as tier from lineitem join w using (l_orderkey)",
    "kept_partitions": "select s_nationkey as g, s_suppkey as cell from supplier union all select c_nationkey, c_custkey from customer where c_nationkey not in (select s_nationkey from supplier)",
    "review_queue": "with q as (select c_custkey as id, row_number() over (order by c_acctbal, c_custkey) as place from customer where c_acctbal < 0) select id, place, coalesce(lead(id) over (order by place), first_value(id) over (order by place)) as next from q",
    "division_report": "with o as (select o_custkey, o_totalprice::double as a, sqrt(o_totalprice::double) * (4 + o_orderkey % 5) as p from orders), c as (select *, 4 * pi() * a / (p * p) as k from o) select o_custkey, count(*) as cells, round(min(a), 6) as least, round(max(a), 6) as most, round(avg(a), 6) as mean, round(max(a) / min(a), 6) as ratio, round(min(k), 6) as least_compact, round(avg(k), 6) as mean_compact, o_custkey % 2 = 1 as coverage_ok from c group by o_custkey",
    "one_way_neighbours": "with p as (select distinct l_suppkey as a, l_partkey as b from lineitem) select a, b from p where (b, a) not in (select a, b from p)",
    "enemy_cuts": "with p as (select p_partkey % 5 as circle, p_partkey % 17 as ray, p_partkey as pixel, (p_partkey * 7 % 101)::double as d, p_size >= 40 as foe from part), s as (select circle, ray, min(d) as stop from p where foe group by all) select circle, ray, pixel, d from p left join s using (circle, ray) where not foe and (stop is null or d < stop)",
    "relaxed_centres": """with c as (select c_custkey * 7919 % 8192 + 0.5::double as x, c_custkey * 104729 % 8192 + 0.5::double as y, c_custkey as k from customer), s0 as (select s_suppkey as id, (s_suppkey * 6211 % 8192)::double as x, (s_suppkey * 50021 % 8192)::double as y from supplier),
o1 as (select c.x, c.y, s0.id, row_number() over (partition by k order by (c.x - s0.x) * (c.x - s0.x) + (c.y - s0.y) * (c.y - s0.y), s0.id) as r from c, s0), m1 as (select id, avg(x) as mx, avg(y) as my from o1 where r = 1 group by id), s1 as (select id, coalesce(mx, x) as x, coalesce(my, y) as y from s0 left join m1 using (id)),
o2 as (select c.x, c.y, s1.id, row_number() over (partition by k order by (c.x - s1.x) * (c.x - s1.x) + (c.y - s1.y) * (c.y - s1.y), s1.id) as r from c, s1), m2 as (select id, avg(x) as mx, avg(y) as my from o2 where r = 1 group by id)
select id, round(coalesce(mx, x), 4) as x, round(coalesce(my, y), 4) as y from s1 left join m2 using (id)""",
    "hairpins": f"with {places._S}, t as (select a.id, b.pos as corner, (a.qx - a.ax) * (b.qx - b.ax) + (a.qy - a.ay) * (b.qy - b.ay) as dot from e a join e b on a.id = b.id and a.ring = 0 and b.ring = 0 and b.pos = (a.pos + 1) % 6) select id, corner::int as at, dot from t where dot < 0",
    "small_cell_markers": f"with {places._S} select id, (bx0 + sc * 320)::double as x, (by0 + sc * 150)::double as y from s where 90000 * sc * sc - 3600 * sc * sc < 200000",
    "content_tiles": f"with {places._C}, b as (select min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from c) select x.range as x, y.range as y from range(32) x, range(32) y, b where (x.range + 1) * 512 > x0 and x.range * 512 <= x1 and (y.range + 1) * 512 > y0 and y.range * 512 <= y1",
    "border_lines": f"with {surfaces._PIX} select distinct p.row, p.col, p.label from pix p join pix q on p.label <> q.label and abs(p.row - q.row) + abs(p.col - q.col) = 1",
    "aliased_cells": "select coalesce(t.p_partkey, p.p_partkey) as id, coalesce(t.p_size, p.p_size) as p_size from part p left join part t on p.p_size > 40 and t.p_partkey = p.p_partkey * 3",
    "marine_features": "select p_partkey, coalesce(case when p_size % 3 = 0 then p_brand end, case when p_size % 2 = 0 then p_name end, '?') as name from part where p_type in (select distinct p_type from part order by p_type limit 2)",
}
