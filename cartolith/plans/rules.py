"""Folds, remaps, roll-ups of pieces and violation rules on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartolith.functions import geo, ids
from cartolith.runtime import table


def smooth_fold(spark: SparkSession, d: str) -> DataFrame:
    """Recursive smoothing along the lines of an order: each value keeps 0.6 of the one before."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_partkey"))).alias("line"))
    fold = F.aggregate(F.slice("line", F.lit(2), F.size("line")), F.element_at("line", 1)["l_extendedprice"], lambda s, p: s * 0.6 + p["l_extendedprice"] * 0.4)
    return g.select("l_orderkey", F.round(fold, 4).alias("smooth"))


def dash_phase(spark: SparkSession, d: str) -> DataFrame:
    """Running length along an order's lines, and the phase in a dash pattern of 12."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").rowsBetween(Window.unboundedPreceding, 0)
    li = table(spark, d, "lineitem").withColumn("run", F.sum("l_quantity").over(w))
    return li.select("l_orderkey", "l_linenumber", "run", (F.col("run") % 12).alias("phase"))


def piece_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose name has at least two pieces, with the number; counted first, so a hot name is no single window."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    n = p.groupBy("p_brand", "p_type").agg(F.count("*").alias("pieces")).where("pieces >= 2")
    return p.join(n, ["p_brand", "p_type"]).select("p_partkey", "pieces")


def _points(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("c_custkey") * 7919 % 8192, F.col("c_custkey") * 104729 % 8192
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", x.alias("x"), y.alias("y"))


def bounds(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).groupBy("c_nationkey").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


def weighted_center(spark: SparkSession, d: str) -> DataFrame:
    """Centre of a region's pieces by their areas; pieces without area have no weight."""
    a = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    g = _points(spark, d).groupBy("c_nationkey").agg(F.sum(a).alias("a"), F.sum(a * F.col("x")).alias("ax"), F.sum(a * F.col("y")).alias("ay"))
    return g.where("a > 0").select("c_nationkey", F.round(F.col("ax") / F.col("a"), 4).alias("x"), F.round(F.col("ay") / F.col("a"), 4).alias("y"))


def country_stats(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("a"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    g = c.join(n, "c_nationkey").groupBy("n_regionkey")
    return g.agg(F.count("*").alias("regions"), F.sum("n").alias("provinces"), F.round(F.avg("a"), 2).alias("mean_region"))


def metric_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Least, largest and mean area of a province's cells, and how far the largest is above the mean."""
    a = F.col("o_totalprice")
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(a).alias("least"), F.max(a).alias("most"), F.avg(a).alias("mean"))
    return g.select("o_custkey", "least", "most", F.round("mean", 4).alias("mean"), F.round(F.col("most") / F.col("mean"), 6).alias("ratio"))


def area_share(spark: SparkSession, d: str) -> DataFrame:
    """A cell's area as its share of its province's area."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    total = o.groupBy("c_custkey").agg(F.sum("o_totalprice").alias("total"))
    parent = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_acctbal").join(total, "c_custkey")
    return o.join(parent, "c_custkey").select("o_orderkey", F.round(F.col("c_acctbal") * F.col("o_totalprice") / F.col("total"), 4).alias("area"))


def alias_remap(spark: SparkSession, d: str) -> DataFrame:
    """Rows take the id and name of their alias's target where that exists; then the area filter applies to what they are."""
    s = table(spark, d, "supplier")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    alias = s.select(F.col("s_suppkey").alias("c_custkey"), (F.col("s_suppkey") * 2).alias("target"))
    target = s.select(F.col("s_suppkey").alias("target"), "s_name", "s_acctbal")
    j = c.join(alias, "c_custkey", "left").join(target, "target", "left")
    j = j.select("c_custkey", F.when(F.col("s_name").isNotNull(), F.col("target")).otherwise(F.col("c_custkey")).alias("id"), F.coalesce("s_name", "c_name").alias("name"), F.coalesce("s_acctbal", "c_acctbal").alias("area"))
    return j.where("area >= 100")


def approved_or_generated(spark: SparkSession, d: str) -> DataFrame:
    """Approved cells of a province where it has any, generated ones elsewhere."""
    o = table(spark, d, "orders")
    old = o.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("cell"), F.lit("approved").alias("origin"))
    new = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), (-F.col("c_custkey")).alias("cell"), F.lit("generated").alias("origin"))
    return old.unionByName(new.join(old.select("o_custkey").distinct(), "o_custkey", "left_anti"))


def shallow_alpha(spark: SparkSession, d: str) -> DataFrame:
    """A step on the land side, a smooth step out to 6000 on the sea side."""
    t = geo.clamp(F.col("c_acctbal") / 6000, 0.0, 1.0)
    a: Column = F.when(F.col("c_acctbal") < 0, 1.0).otherwise(1 - t * t * (3 - 2 * t))
    return table(spark, d, "customer").select("c_custkey", F.round(a, 6).alias("alpha"))


def kept_islands(spark: SparkSession, d: str) -> DataFrame:
    """Pieces above the floor, or the two largest of their province, outside the excluded box unless above its ceiling."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("area"))
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("area"), "l_linenumber", "l_partkey"))
    x, y = F.col("l_partkey") * 7919 % 8192, F.col("l_partkey") * 104729 % 8192
    zone = x.between(1000, 3000) & y.between(1000, 3000) & (F.col("area") <= 20000)
    li = li.withColumn("rank", rank).where(((F.col("area") >= 10000) | (F.col("rank") <= 2)) & ~zone)
    return li.select("l_orderkey", "l_linenumber", "area")


def forbidden_fields(spark: SparkSession, d: str) -> DataFrame:
    """Records with a key that their kind of document may not have."""
    e = table(spark, d, "events").where("event_type <> 'click'")
    keys = F.map_keys(F.from_json("props", "map<string,string>"))
    return e.select("event_id", F.explode(F.filter(keys, lambda k: k.isin("k", "zone") | k.startswith("zone_"))).alias("field"))


def forbidden_phrases(spark: SparkSession, d: str) -> DataFrame:
    found = F.filter(F.array(*map(F.lit, ("license", "the ", "http"))), lambda t: F.contains(F.lower("text"), t))
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ",").alias("found")).where("found <> ''")


def hierarchy_faults(spark: SparkSession, d: str) -> DataFrame:
    """One row a fault: a region that does not exist, a macroregion that is not the region's, one without a region."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 13 == 0, F.lit(99)).when(F.col("c_custkey") % 17 != 0, F.col("c_nationkey")).alias("region"), (F.col("c_custkey") % 5).cast("int").alias("macro"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("region"), "n_regionkey", F.lit(True).alias("there"))
    fault = F.when(F.col("region").isNull(), "macro_without_region").when(F.col("there").isNull(), "no_such_region").when(F.col("macro") != F.col("n_regionkey"), "other_macro")
    return c.join(n, "region", "left").select("c_custkey", fault.alias("fault")).where("fault is not null")


def alias_faults(spark: SparkSession, d: str) -> DataFrame:
    """Aliases whose target is missing, and aliases whose source is still a real id."""
    a = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") * 3).alias("new"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("old"))
    missing = a.join(table(spark, d, "part").select(F.col("p_partkey").alias("new")), "new", "left_anti").select("old", F.lit("no_target").alias("fault"))
    return missing.union(a.join(s, "old", "left_semi").select("old", F.lit("still_real")))


def registry_faults(spark: SparkSession, d: str) -> DataFrame:
    """Keys with another number than the registry's, and derived ids that are not level:number."""
    s = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 9 == 0, F.col("s_suppkey") + 1).otherwise(F.col("s_suppkey")).alias("number"))
    s = s.withColumn("derived", F.concat(F.when(F.col("s_suppkey") % 7 == 0, "Province:").otherwise("province:"), F.col("s_suppkey").cast("string")))
    fault = F.concat_ws(",", F.when(F.col("number") != F.col("s_suppkey"), "number"), F.when(F.col("derived") != F.concat(F.lit("province:"), F.col("number").cast("string")), "derived"), F.when(~ids.id_ok(F.col("derived")), "grammar"))
    return s.select("s_suppkey", fault.alias("fault")).where("fault <> ''")


def viewport_diff(spark: SparkSession, d: str) -> DataFrame:
    """Tiles to load and to drop when a user's needed set (purchases) meets the active one (clicks)."""
    e = table(spark, d, "events").select("user_id", "event_type", (F.col("event_id") % 16).alias("tile"))
    g = e.groupBy("user_id", "tile").agg(F.bool_or(F.col("event_type") == "purchase").alias("need"), F.bool_or(F.col("event_type") == "click").alias("active"))
    return g.where("need <> active").select("user_id", "tile", F.when(F.col("need"), "load").otherwise("drop").alias("action"))


def tile_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tiles at each zoom that hold a point, without those of one value (flat tiles are not written)."""
    p = _points(spark, d).select("c_nationkey", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("z"), "x", "y")
    side = F.lit(8192) / F.pow(F.lit(2.0), F.col("z"))
    p = p.groupBy("z", F.floor(F.col("x") / side).alias("tx"), F.floor(F.col("y") / side).alias("ty")).agg(F.min("c_nationkey").alias("lo"), F.max("c_nationkey").alias("hi"))
    return p.groupBy("z").agg(F.count("*").alias("tiles"), F.count_if(F.col("lo") < F.col("hi")).alias("written"))


def first_of_each(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each name in document order."""
    return table(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("first"))


QUERIES = {f.__name__: f for f in (smooth_fold, dash_phase, piece_counts, bounds, weighted_center, country_stats, metric_ratios, area_share, alias_remap, approved_or_generated, shallow_alpha, kept_islands, forbidden_fields, forbidden_phrases, hierarchy_faults, alias_faults, registry_faults, viewport_diff, tile_counts, first_of_each)}

_P = "with p as (select *, c_custkey * 7919 % 8192 as x, c_custkey * 104729 % 8192 as y from customer) "
SQL = {
    "smooth_fold": "select l_orderkey, round(list_reduce(list(l_extendedprice order by l_linenumber, l_extendedprice, l_partkey), lambda s, p: s * 0.6::double + p * 0.4::double), 4) as smooth from lineitem group by 1",
    "dash_phase": "with r as (select *, sum(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity rows unbounded preceding) as run from lineitem) select l_orderkey, l_linenumber, run, run % 12 as phase from r",
    "piece_counts": "select p_partkey, count(*) over (partition by p_brand, p_type) as pieces from part qualify pieces >= 2",
    "bounds": _P + "select c_nationkey, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from p group by 1",
    "weighted_center": _P + "select c_nationkey, round(sum(greatest(c_acctbal, 0) * x) / sum(greatest(c_acctbal, 0)), 4) as x, round(sum(greatest(c_acctbal, 0) * y) / sum(greatest(c_acctbal, 0)), 4) as y from p group by 1 having sum(greatest(c_acctbal, 0)) > 0",
    "country_stats": "with c as (select c_nationkey, count(*) as n, sum(c_acctbal) as a from customer group by 1) select n_regionkey, count(*) as regions, cast(sum(n) as bigint) as provinces, round(avg(a), 2) as mean_region from c join nation on n_nationkey = c_nationkey group by 1",
    "metric_ratios": "select o_custkey, min(o_totalprice) as least, max(o_totalprice) as most, round(avg(o_totalprice), 4) as mean, round(max(o_totalprice) / avg(o_totalprice), 6) as ratio from orders group by 1",
    "area_share": "select o_orderkey, round(c_acctbal * o_totalprice / sum(o_totalprice) over (partition by o_custkey), 4) as area from orders join customer on c_custkey = o_custkey where c_acctbal > 0",
    "alias_remap": "with j as (select c_custkey, case when t.s_name is not null then t.s_suppkey else c_custkey end as id, coalesce(t.s_name, c_name) as name, coalesce(t.s_acctbal, c_acctbal) as area from customer left join supplier a on a.s_suppkey = c_custkey left join supplier t on t.s_suppkey = a.s_suppkey * 2) select * from j where area >= 100",
    "approved_or_generated": "select o_custkey, o_orderkey as cell, 'approved' as origin from orders where o_orderstatus = 'F' union all select c_custkey, -c_custkey, 'generated' from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')",
    "shallow_alpha": "with t as (select c_custkey, c_acctbal, greatest(0.0, least(1.0, c_acctbal / 6000)) as t from customer) select c_custkey, round(case when c_acctbal < 0 then 1.0::double else 1 - t * t * (3 - 2 * t) end, 6) as alpha from t",
    "kept_islands": "with r as (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_partkey) as r from lineitem) select l_orderkey, l_linenumber, l_extendedprice as area from r where (l_extendedprice >= 10000 or r <= 2) and not (l_partkey * 7919 % 8192 between 1000 and 3000 and l_partkey * 104729 % 8192 between 1000 and 3000 and l_extendedprice <= 20000)",
    "forbidden_fields": "with k as (select event_id, unnest(json_keys(props)) as field from events where event_type <> 'click') select * from k where field in ('k', 'zone') or starts_with(field, 'zone_')",
    "forbidden_phrases": "with f as (select doc_id, array_to_string(list_filter(['license', 'the ', 'http'], lambda t: contains(lower(text), t)), ',') as found from documents) select * from f where found <> ''",
    "hierarchy_faults": "with c as (select c_custkey, case when c_custkey % 13 = 0 then 99 when c_custkey % 17 <> 0 then c_nationkey end as region, c_custkey % 5 as macro from customer), f as (select c_custkey, case when region is null then 'macro_without_region' when n_nationkey is null then 'no_such_region' when macro <> n_regionkey then 'other_macro' end as fault from c left join nation on n_nationkey = region) select * from f where fault is not null",
    "alias_faults": "with a as (select p_partkey as old, p_partkey * 3 as new from part where p_size > 25) select old, 'no_target' as fault from a where new not in (select p_partkey from part) union all select old, 'still_real' from a where old in (select s_suppkey from supplier)",
    "registry_faults": "with s as (select s_suppkey, case when s_suppkey % 9 = 0 then s_suppkey + 1 else s_suppkey end as number, case when s_suppkey % 7 = 0 then 'Province:' else 'province:' end || s_suppkey as derived from supplier), f as (select s_suppkey, concat_ws(',', case when number <> s_suppkey then 'number' end, case when derived <> 'province:' || number then 'derived' end, case when not regexp_matches(derived, '^[a-z][a-z0-9_]*(:[a-z0-9_]+)+$') then 'grammar' end) as fault from s) select * from f where fault <> ''",
    "viewport_diff": "with g as (select user_id, event_id % 16 as tile, bool_or(event_type = 'purchase') as need, bool_or(event_type = 'click') as active from events group by 1, 2) select user_id, tile, case when need then 'load' else 'drop' end as action from g where need <> active",
    "tile_counts": _P + ", z as (select unnest(range(7))::int as z), t as (select z, floor(x / (8192 / pow(2, z))) as tx, floor(y / (8192 / pow(2, z))) as ty, min(c_nationkey) as lo, max(c_nationkey) as hi from p, z group by 1, 2, 3) select z, count(*) as tiles, count(*) filter (where lo < hi) as written from t group by 1",
    "first_of_each": "select p_name, min(p_partkey) as first from part group by 1",
}
