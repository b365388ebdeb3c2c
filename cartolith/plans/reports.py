"""Area report, roll-ups, scalars and integrity queries on the driver's tables, with their SQL.

Bindings: region, nation and customer are macroregion, region and province; orders are a province's cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartolith.functions import geo, ids
from cartolith.operators import tables
from cartolith.runtime import table

OVERRIDES = [(7, 5, None), (19, None, 9), (23, 2, None), (101, 8, 4)]


def _report(spark: SparkSession, d: str) -> DataFrame:
    """Province with region, macroregion, area, expected and final cell count and a status."""
    over = spark.createDataFrame(OVERRIDES, "c_custkey long, least int, forced int")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("area_km2"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey", (F.lit(500.0) + 100 * F.col("n_nationkey")).alias("target"))
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = c.join(n, "c_nationkey", "left").join(r, "n_regionkey", "left").join(F.broadcast(over), "c_custkey", "left")
    base = F.when(F.col("area_km2") > 0, F.least(F.lit(6), F.greatest(F.lit(1), geo.half_up(F.col("area_km2") / F.col("target")))).cast("int"))
    j = j.withColumn("expected", base)
    final = F.when(F.col("expected").isNotNull(), F.coalesce("forced", F.greatest("expected", F.coalesce("least", F.lit(0)))))
    status = F.when(F.col("n_name").isNull(), "NO_REGION").when(F.col("area_km2").isNull() | (F.col("area_km2") <= 0), "NO_AREA").otherwise("OK")
    return j.select("c_custkey", "n_name", "r_name", "area_km2", "expected", final.cast("int").alias("final"), status.alias("status"))


_REPORT = """
with o(c_custkey, least_n, forced) as (values (7, 5, null), (19, null, 9), (23, 2, null), (101, 8, 4)),
j as (select c.c_custkey, n_name, r_name, c_acctbal as area_km2, least_n, forced,
        case when c_acctbal > 0 then cast(least(6, greatest(1, floor(c_acctbal / (500 + 100 * n_nationkey) + 0.5))) as int) end as expected
      from customer c left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey left join o on o.c_custkey = c.c_custkey),
report as (select c_custkey, n_name, r_name, area_km2, expected,
        cast(case when expected is not null then coalesce(forced, greatest(expected, coalesce(least_n, 0))) end as int) as final,
        case when n_name is null then 'NO_REGION' when area_km2 is null or area_km2 <= 0 then 'NO_AREA' else 'OK' end as status from j)
"""


def area_report(spark, d):
    return _report(spark, d)


def region_rollup(spark, d):
    g = _report(spark, d).where("n_name is not null").groupBy("r_name", "n_name")
    return g.agg(F.count("*").alias("provinces"), F.round(F.sum("area_km2"), 2).alias("area"), F.sum("expected").alias("expected"), F.sum("final").alias("final"), F.count_if(F.col("final") != F.col("expected")).alias("overridden"))


def area_summary(spark, d):
    ok = F.when(F.col("area_km2") > 0, F.col("area_km2"))
    return _report(spark, d).agg(F.count("*").alias("n"), F.round(F.sum(ok), 2).alias("total"), F.min(ok).alias("least"), F.median(ok).alias("middle"), F.max(ok).alias("most"), F.count_if(F.col("status") == "OK").alias("ok"), F.count_distinct("n_name").alias("regions"))


def status_histogram(spark, d):
    return _report(spark, d).groupBy("r_name").pivot("status", ["OK", "NO_AREA", "NO_REGION"]).count().na.fill(0)


def area_quantiles(spark, d):
    return _report(spark, d).groupBy("n_name").agg(F.percentile("area_km2", 0.25).alias("q25"), F.percentile("area_km2", 0.9).alias("q90"))


def cv_balance(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.stddev_pop("o_totalprice") / F.avg("o_totalprice"), 6).alias("cv"), F.round(F.min("o_totalprice") / F.avg("o_totalprice"), 6).alias("smallest"))
    return g


def _px(x: Column, y: Column):
    return x * 7919 % 8192, y * 104729 % 8192


def mercator_project(spark, d):
    lon, lat = F.col("c_custkey") * 7919 % 36000 / 100.0 - 180, F.col("c_custkey") * 104729 % 16000 / 100.0 - 80
    x, y = geo.to_world(lon, lat)
    lon2, lat2 = geo.to_lonlat(x, y)
    return table(spark, d, "customer").select("c_custkey", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"), F.round(lon2, 4).alias("lon"), F.round(lat2, 4).alias("lat"), F.round(geo.km_per_px(y), 4).alias("km"))


def capacity(spark, d):
    a = F.col("l_extendedprice")
    factor = geo.clamp(F.sqrt(F.greatest(a, F.lit(0.0)) / 1000), 0.4, 4.0)
    cap = a * 35 * 1.1 * F.coalesce(F.try_element_at(F.create_map(*map(F.lit, (0, 1.1, 1, 1.0, 2, 0.7, 3, 0.4))), (F.col("l_linenumber") % 5).cast("int")), F.lit(1.0)) * F.lit(0.95)
    people = F.greatest(F.lit(300), F.round(cap * F.col("l_discount")))
    move = geo.clamp(F.col("l_quantity") / 40 * (1 + F.col("l_tax")), 0.5, 5.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(factor, 6).alias("factor"), F.round(cap, 6).alias("capacity"), people.cast("long").alias("people"), F.round(move, 6).alias("move_cost"))


def classes(spark, d):
    q = F.col("l_quantity") * 15
    band = F.when(q <= 90, "coastal").when(q <= 220, "dense_sea").when(q <= 500, "regional_sea").otherwise("ocean_transition")
    tier = F.when(F.col("l_quantity") <= 2, 1).when(F.col("l_quantity") <= 5, 2).when(F.col("l_quantity") <= 8, 3)
    keep = F.when(q <= 90, 1.0).when(q <= 240, 0.72).otherwise(0.46)
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 * (1 - (F.col("l_discount") - 0.02) / 0.06))), 6)
    return table(spark, d, "lineitem").groupBy(band.alias("band"), tier.alias("tier"), keep.alias("keep")).agg(F.count("*").alias("n"), F.round(F.avg(score), 4).alias("score"))


def complexity_count(spark, d):
    f = geo.clamp(F.lit(1.05) * F.when(F.col("p_size") < 10, 1.0).when(F.col("p_size") < 25, 1.05).when(F.col("p_size") < 40, 1.12).otherwise(1.18), 0.85, 1.35)
    n = F.least(F.lit(6), F.greatest(F.lit(2), F.bround(F.col("p_retailprice") * f / 450).cast("int")))
    return table(spark, d, "part").select("p_partkey", n.alias("cells"))


def codec16(spark, d):
    v = F.bround(geo.clamp((F.col("c_acctbal") + 1000) / 11000, 0.0, 1.0) * 65535).cast("int")
    hi, lo = F.floor(v / 256).cast("int"), (v % 256).cast("int")
    return table(spark, d, "customer").select("c_custkey", hi.alias("hi"), lo.alias("lo"), F.round((hi * 256 + lo) / 65535 * 11000 - 1000, 3).alias("decoded"))


def name_hashes(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", ids.djb2(n).alias("djb2"), F.round(ids.fnv_noise(n), 9).alias("fnv"), F.round(ids.md5_unit(n), 9).alias("unit"), F.round((F.col("p_partkey") * 0.61803398875) % 1, 6).alias("hue"))


def slugs(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", ids.slug(n).alias("slug"), ids.name_key(n).alias("name_key"), ids.id_ok(F.concat(F.lit("part:"), ids.slug(n))).alias("ok"), F.format_string("land_cell:%d:%02d", F.col("p_partkey"), F.col("p_size")).alias("cell_id"))


def url_parts(spark, d):
    return table(spark, d, "pages").select("page_id", F.substring_index("url", "/", 3).alias("site"), F.col("url").rlike("^https?://[^/]+").alias("is_http"), F.size(F.split("url", "/")).alias("parts"))


def duplicate_names(spark, d):
    return tables.duplicates(table(spark, d, "part"), "p_name")


def collision_levels(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("s").alias("level"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("c").alias("level"))
    return a.union(b).groupBy("id").agg(F.count_distinct("level").alias("levels")).where("levels > 1")


def duplicate_pairs(spark, d):
    li = table(spark, d, "lineitem")
    g = li.groupBy(F.least("l_partkey", "l_suppkey").alias("a"), F.greatest("l_partkey", "l_suppkey").alias("b"))
    return g.agg(F.count("*").alias("n")).where("n > 1")


def orphan_labels(spark, d):
    return tables.orphans(table(spark, d, "documents").select("doc_id", "source"), "doc_id", table(spark, d, "labels"), "doc_id")


def reconcile_parts(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("v")).where("v > 4")
    q = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("v"), "p_size").where("p_size < 47").drop("p_size")
    return tables.reconcile(p, q, "id", ["v"])


def occurrence_ids(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return tables.occurrence_suffix(p, "p_brand", ["p_partkey"]).select("p_partkey", "new_id")


def top_areas(spark, d):
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return tables.top_n(c, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3)


def argmax_cell(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("largest"), F.count("*").alias("cells"))


def registry_alloc(spark, d):
    s = table(spark, d, "supplier")
    reg = s.where("s_acctbal > 0").select(F.concat(F.lit("k"), "s_suppkey").alias("k"), F.col("s_suppkey").alias("numeric_id"))
    keys = s.select(F.concat(F.lit("k"), "s_suppkey").alias("k"), F.col("s_suppkey").alias("ord"))
    return tables.allocate_ids(keys, reg, "k", "ord")


def upsert_cells(spark, d):
    old = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    new = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"), F.col("s_name").alias("note"))
    return tables.replace_by_key(old, new, "id")


def prefix_join(spark, d):
    """Lines as pieces o_order_line_supplier; orders are their targets, and returned lines targets of their own."""
    li = table(spark, d, "lineitem")
    pieces = li.select(F.concat_ws("_", F.lit("o"), "l_orderkey", "l_linenumber", "l_suppkey").alias("piece")).distinct()
    targets = table(spark, d, "orders").select(F.concat_ws("_", F.lit("o"), "o_orderkey").alias("target"))
    more = li.where("l_returnflag = 'R'").select(F.concat_ws("_", F.lit("o"), "l_orderkey", "l_linenumber").alias("target"))
    return tables.longest_prefix(pieces, "piece", targets.union(more), "target")


def hidden_by_area(spark, d):
    li = table(spark, d, "lineitem")
    hidden = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("area"), F.bool_or(F.col("l_returnflag") == "A").alias("exempt")).where("area < 20 and not exempt").select("l_orderkey")
    return li.select("l_orderkey", "l_linenumber").join(hidden, "l_orderkey", "left_anti")


def angular_order(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 7919 % 8192).alias("x"), (F.col("o_orderkey") * 104729 % 8192).alias("y"))
    own = Window.partitionBy("o_custkey")
    a = F.round(F.atan2(F.col("y") - F.avg("y").over(own), F.col("x") - F.avg("x").over(own)), 9)
    o = o.withColumn("angle", a)
    return o.select("o_custkey", "o_orderkey", F.row_number().over(own.orderBy((F.col("o_orderkey") % 4 != 0).cast("int"), "angle", "o_orderkey")).alias("place"))


def debounce(spark, d):
    e = table(spark, d, "events")
    nxt = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.withColumn("next_ts", nxt).where(F.col("next_ts").isNull() | (F.unix_micros(F.col("next_ts").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")) > 600_000_000)).select("event_id", "user_id")


def event_runs(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("new", F.coalesce((F.col("event_type") != F.lag("event_type").over(w)).cast("int"), F.lit(1)))
    e = e.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"))


def quality_status(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.avg("l_discount").alias("a"), F.avg("l_tax").alias("b"), F.count("*").alias("n"), F.max("l_quantity").alias("q"))
    s = 25 * F.least(F.lit(1.0), F.col("a") * 10) + 35 * F.least(F.lit(1.0), F.col("b") * 12.5) + 40 * F.col("n") / 7
    s = F.round(F.when(F.col("q") >= 50, F.least(F.lit(49.0), s)).otherwise(s), 4)
    return li.select("l_orderkey", s.alias("score"), F.when(s >= 90, "AUTO").when(s < 75, "NEEDS_REVIEW").otherwise("ACCEPTED").alias("status"))


def interzone_edges(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = table(spark, d, "lineitem").join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey").where("c_nationkey <> s_nationkey")
    return j.groupBy(F.least("c_nationkey", "s_nationkey").alias("a"), F.greatest("c_nationkey", "s_nationkey").alias("b")).agg(F.count("*").alias("edges"), F.round(F.sum("l_quantity"), 2).alias("length"))


QUERIES = {f.__name__: f for f in (area_report, region_rollup, area_summary, status_histogram, area_quantiles, cv_balance, mercator_project, capacity, classes, complexity_count, codec16, name_hashes, slugs, url_parts, duplicate_names, collision_levels, duplicate_pairs, orphan_labels, reconcile_parts, occurrence_ids, top_areas, argmax_cell, registry_alloc, upsert_cells, prefix_join, hidden_by_area, angular_order, debounce, event_runs, quality_status, interzone_edges)}

_XY = """with p as (select c_custkey, c_custkey * 7919 % 36000 / 100.0::double - 180 as lon, c_custkey * 104729 % 16000 / 100.0::double - 80 as lat from customer),
w as (select c_custkey, (lon + 180) / 360 * 8192 as x, (0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * 8192 as y from p)"""
SQL = {
    "name_hashes": "with c as (select p_partkey, p_name, list_transform(string_split(p_name, ''), lambda x: unicode(x)::bigint) as u from part) select p_partkey, list_reduce(u, lambda h, x: (h * 33 + x) % 4294967296, 5381::bigint) as djb2, round(list_reduce(u, lambda h, x: (xor(h, x) * 16777619) % 4294967296, 2166136261::bigint) / 4294967295.0::double * 2 - 1, 9) as fnv, round(('0x' || substr(md5(p_name), 1, 8))::bigint / 4294967295.0::double, 9) as unit, round((p_partkey * 0.61803398875::double) % 1, 6) as hue from c",
    "area_report": _REPORT + "select * from report",
    "region_rollup": _REPORT + "select r_name, n_name, count(*) as provinces, round(sum(area_km2), 2) as area, sum(expected) as expected, sum(final) as final, count(*) filter (where final <> expected) as overridden from report where n_name is not null group by all",
    "area_summary": _REPORT + "select count(*) as n, round(sum(area_km2) filter (where area_km2 > 0), 2) as total, min(area_km2) filter (where area_km2 > 0) as least, median(area_km2) filter (where area_km2 > 0) as middle, max(area_km2) filter (where area_km2 > 0) as most, count(*) filter (where status = 'OK') as ok, count(distinct n_name) as regions from report",
    "status_histogram": _REPORT + "select r_name, count(*) filter (where status = 'OK') as \"OK\", count(*) filter (where status = 'NO_AREA') as \"NO_AREA\", count(*) filter (where status = 'NO_REGION') as \"NO_REGION\" from report group by r_name",
    "area_quantiles": _REPORT + "select n_name, quantile_cont(area_km2, 0.25) as q25, quantile_cont(area_km2, 0.9) as q90 from report group by n_name",
    "cv_balance": "select o_custkey, round(stddev_pop(o_totalprice) / avg(o_totalprice), 6) as cv, round(min(o_totalprice) / avg(o_totalprice), 6) as smallest from orders group by o_custkey",
    "mercator_project": _XY + "select c_custkey, round(x, 4) as x, round(y, 4) as y, round(x / 8192 * 360 - 180, 4) as lon, round(degrees(atan(sinh(pi() * (1 - 2 * y / 8192)))), 4) as lat, round(2 * pi() * 6371.0 / 8192 * cos(atan(sinh(pi() * (1 - 2 * y / 8192)))), 4) as km from w",
    "capacity": "with f as (select *, case l_linenumber % 5 when 0 then 1.1::double when 1 then 1.0 when 2 then 0.7 when 3 then 0.4 else 1.0 end as r from lineitem), g as (select *, l_extendedprice * 35 * 1.1::double * r * 0.95::double as cap from f) select l_orderkey, l_linenumber, round(greatest(0.4, least(4.0, sqrt(greatest(l_extendedprice, 0) / 1000))), 6) as factor, round(cap, 6) as capacity, cast(greatest(300, round(cap * l_discount)) as bigint) as people, round(greatest(0.5, least(5.0, l_quantity / 40 * (1 + l_tax))), 6) as move_cost from g",
    "classes": "select case when l_quantity * 15 <= 90 then 'coastal' when l_quantity * 15 <= 220 then 'dense_sea' when l_quantity * 15 <= 500 then 'regional_sea' else 'ocean_transition' end as band, cast(case when l_quantity <= 2 then 1 when l_quantity <= 5 then 2 when l_quantity <= 8 then 3 end as int) as tier, cast(case when l_quantity * 15 <= 90 then 1.0 when l_quantity * 15 <= 240 then 0.72 else 0.46 end as double) as keep, count(*) as n, round(avg(round(greatest(0, least(100, 100 * (1 - (l_discount - 0.02) / 0.06))), 6)), 4) as score from lineitem group by 1, 2, 3",
    "complexity_count": "select p_partkey, cast(least(6, greatest(2, round_even(p_retailprice * greatest(0.85, least(1.35, 1.05::double * case when p_size < 10 then 1.0::double when p_size < 25 then 1.05 when p_size < 40 then 1.12 else 1.18 end)) / 450, 0))) as int) as cells from part",
    "codec16": "with v as (select c_custkey, cast(round_even(greatest(0.0, least(1.0, (c_acctbal + 1000) / 11000)) * 65535, 0) as int) as v from customer) select c_custkey, cast(v // 256 as int) as hi, cast(v % 256 as int) as lo, round(v / 65535 * 11000 - 1000, 3) as decoded from v",
    "slugs": r"with s as (select *, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') as t from part), u as (select *, case when t = '' then 'unnamed' else t end as slug from s) select p_partkey, slug, trim(regexp_replace(lower(p_name), '\s+', ' ', 'g')) as name_key, regexp_matches('part:' || slug, '^[a-z][a-z0-9_]*(:[a-z0-9_]+)*$') as ok, printf('land_cell:%d:%02d', p_partkey, p_size) as cell_id from u",
    "url_parts": "select page_id, array_to_string(string_split(url, '/')[1:3], '/') as site, regexp_matches(url, '^https?://[^/]+') as is_http, cast(len(string_split(url, '/')) as int) as parts from pages",
    "duplicate_names": "select p_name, count(*) as times from part where p_name is not null and p_name <> '' group by p_name having count(*) > 1",
    "collision_levels": "select id, count(distinct level) as levels from (select s_suppkey as id, 's' as level from supplier union all select c_custkey, 'c' from customer) group by id having count(distinct level) > 1",
    "duplicate_pairs": "select least(l_partkey, l_suppkey) as a, greatest(l_partkey, l_suppkey) as b, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
    "orphan_labels": "select doc_id, source from documents where doc_id not in (select doc_id from labels where doc_id is not null)",
    "reconcile_parts": "with l as (select p_partkey as id, p_size as v from part where p_size > 4), r as (select p_partkey as id, case when p_partkey % 11 = 0 then null else p_size end as v from part where p_size < 47), j as (select coalesce(l.id, r.id) as id, case when r.id is null then 'only_left' when l.id is null then 'only_right' when l.v is distinct from r.v then 'mismatch' end as finding from l full join r on l.id = r.id) select * from j where finding is not null",
    "occurrence_ids": "with n as (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) as n from part) select p_partkey, case when n = 1 then p_brand else p_brand || '_' || n end as new_id from n",
    "top_areas": "select c_nationkey, c_custkey, c_acctbal, cast(row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as int) as rank from customer qualify rank <= 3",
    "argmax_cell": "with n as (select o_custkey, o_orderkey, count(*) over (partition by o_custkey) as cells, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as r from orders) select o_custkey, o_orderkey as largest, cells from n where r = 1",
    "registry_alloc": "with reg as (select 'k' || s_suppkey as k, s_suppkey as numeric_id from supplier where s_acctbal > 0) select 'k' || s_suppkey as k, coalesce(numeric_id, (select max(numeric_id) from reg) + row_number() over (partition by numeric_id is null order by s_suppkey)) as numeric_id, numeric_id is null as is_new from supplier left join reg on reg.k = 'k' || s_suppkey",
    "upsert_cells": "select c_custkey as id, c_acctbal as v, null::varchar as note from customer where c_custkey not in (select s_suppkey from supplier) union all select s_suppkey, s_acctbal, s_name from supplier",
    "prefix_join": "with p as (select distinct l_orderkey as k, l_linenumber as n, l_suppkey as s from lineitem), t as (select 'o_' || o_orderkey as target from orders union select 'o_' || l_orderkey || '_' || l_linenumber from lineitem where l_returnflag = 'R'), c as (select 'o_' || k || '_' || n || '_' || s as piece, unnest(['o_' || k, 'o_' || k || '_' || n, 'o_' || k || '_' || n || '_' || s]) as target from p) select piece, max_by(target, length(target)) as target from c join t using (target) group by piece",
    "hidden_by_area": "select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select l_orderkey from lineitem group by l_orderkey having sum(l_quantity) < 20 and not bool_or(l_returnflag = 'A'))",
    "angular_order": "with o as (select o_custkey, o_orderkey, o_orderkey * 7919 % 8192 as x, o_orderkey * 104729 % 8192 as y from orders), a as (select *, round(atan2(y - avg(y) over (partition by o_custkey), x - avg(x) over (partition by o_custkey)), 9) as angle from o) select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by (o_orderkey % 4 <> 0)::int, angle, o_orderkey) as int) as place from a",
    "debounce": "with n as (select *, lead(ts) over (partition by user_id order by ts, event_id) as next_ts from events) select event_id, user_id from n where next_ts is null or epoch_us(next_ts) - epoch_us(ts) > 600000000",
    "event_runs": "with a as (select *, coalesce((event_type <> lag(event_type) over (partition by user_id order by ts, event_id))::int, 1) as new from events), b as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as run from a) select user_id, cast(run as bigint) as run, event_type, count(*) as n from b group by all",
    "quality_status": "with g as (select l_orderkey, avg(l_discount) as a, avg(l_tax) as b, count(*) as n, max(l_quantity) as q from lineitem group by 1), s as (select l_orderkey, q, 25 * least(1.0, a * 10) + 35 * least(1.0, b * 12.5) + 40 * n / 7 as s from g), t as (select l_orderkey, round(case when q >= 50 then least(49.0, s) else s end, 4) as score from s) select l_orderkey, score, case when score >= 90 then 'AUTO' when score < 75 then 'NEEDS_REVIEW' else 'ACCEPTED' end as status from t",
    "interzone_edges": "select least(c_nationkey, s_nationkey) as a, greatest(c_nationkey, s_nationkey) as b, count(*) as edges, round(sum(l_quantity), 2) as length from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey where c_nationkey <> s_nationkey group by 1, 2",
}
