"""Layers of cells: properties, selections, parts and wholes, queues, partitions and seeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartolith.functions import geo
from cartolith.operators import graph
from cartolith.operators.tables import numbered
from cartolith.runtime import materialize


def set_properties(cells: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """cells with the values of changes (key, some of the columns) where these are not null; unknown keys change nothing."""
    own = [c for c in changes.columns if c != key]
    j = cells.join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in own]), key, "left")
    return j.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in own else c for c in cells.columns])


def painted(cells: DataFrame, modes: dict[str, Callable[[DataFrame], Column]], mode: str, out: str = "color") -> DataFrame:
    """cells with a colour by a named mode: a function from the table to a column."""
    return cells.withColumn(out, modes[mode](cells))


def kept_or_made(approved: DataFrame, made: DataFrame, group: str) -> DataFrame:
    """The approved rows of a group, else those that were made."""
    return approved.unionByName(made.join(approved.select(group).distinct(), group, "left_anti"), allowMissingColumns=True)


def remapped(cells: DataFrame, aliases: DataFrame, key: str, targets: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """cells whose key has an alias (key, to) take that id, and the target's columns, where such a target exists."""
    goals = aliases.join(targets.select(F.col(key).alias("to"), *[F.col(c).alias(f"_to_{c}") for c in columns]), "to")
    j = cells.join(goals, key, "left")
    return j.select(*[F.coalesce("to", c).alias(c) if c == key else F.when(F.col("to").isNotNull(), F.col(f"_to_{c}")).otherwise(F.col(c)).alias(c) if c in columns else c for c in cells.columns])


def of_classes(features: DataFrame, kind: str, classes: tuple[str, ...], names: tuple[str, ...], unnamed: str) -> DataFrame:
    """Features of the listed classes, with the first of their name columns that is not empty."""
    name = F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names], F.lit(unnamed))
    return features.where(F.col(kind).isin(*classes)).withColumn("name", name)


def allocated(pieces: DataFrame, allowed: DataFrame, index: str) -> DataFrame:
    """Pieces at the listed places (index, group) with the group they go to; the others are left out."""
    return pieces.join(allowed, index)


def whole_areas(parts: DataFrame, feature: str, area: str) -> DataFrame:
    """parts with `whole`, the area of all parts of their feature; summed first, so that a feature of many parts is no single window."""
    return parts.join(parts.groupBy(feature).agg(F.sum(area).alias("whole")), feature)


def small_markers(cells: DataFrame, area: str, most: float) -> DataFrame:
    """id, x, y of cells below an area: a point inside each."""
    return cells.where(F.col(area) < most).select("id", geo.inner_point(F.col("rings")).alias("p")).select("id", "p.x", "p.y")


def tiles_with_content(zoom: int, bounds: tuple[float, float, float, float], world: float, spark) -> DataFrame:
    """(x, y) of the zoom's tiles that touch the bounds of a layer's content."""
    side = world / (1 << zoom)
    x0, y0, x1, y1 = bounds
    span = lambda a, b: spark.range(max(0, int(a // side)), min((1 << zoom) - 1, int(b // side)) + 1)
    return span(x0, x1).withColumnRenamed("id", "x").crossJoin(span(y0, y1).withColumnRenamed("id", "y"))


def next_in_queue(items: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """key, place, next: each open item's place in the review queue and the one after it; the last goes on to the first."""
    n = numbered(items, order)
    first = n.where("place = 1").select(F.lit(None).cast("long").alias("back"), F.col(key).alias("next"))
    after = n.select((F.col("place") - 1).alias("back"), F.col(key).alias("next"))
    wrapped = n.agg(F.max("place").alias("back")).join(first.select("next"), F.lit(True))
    return n.select(key, "place").join(after.where("back > 0").union(wrapped.select("back", "next")), F.col("place") == F.col("back"), "left").select(key, "place", "next")


def partition_report(cells: DataFrame, group: str, area: str, outline: str, parent: DataFrame, tolerance: float) -> DataFrame:
    """One row for each divided group: number of cells, least, largest and mean area, ratio, compactness, coverage.

    cells have group, area and outline (length); parent has group and whole (area). coverage_ok means that the areas
    add up to the whole within tolerance.
    """
    dense = geo.compactness(F.col(area), F.col(outline))
    g = cells.groupBy(group).agg(F.count("*").alias("cells"), F.min(area).alias("least"), F.max(area).alias("most"), F.avg(area).alias("mean"), F.sum(area).alias("total"), F.min(dense).alias("least_compact"), F.avg(dense).alias("mean_compact"))
    return g.join(parent.select(group, "whole"), group).select(group, "cells", "least", "most", "mean", (F.col("most") / F.greatest("least", F.lit(1e-9))).alias("ratio"), "least_compact", "mean_compact", (F.abs(F.col("total") - F.col("whole")) < tolerance).alias("coverage_ok"))


def asymmetric(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of a neighbour list whose other direction is missing."""
    return pairs.select("a", "b").exceptAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def cut_by_enemies(pixels: DataFrame) -> DataFrame:
    """Along each (circle, ray): the circle's own pixels (owner = circle) nearer than the nearest foreign one.

    pixels have circle, ray, pixel, d and owner. One aggregate and a join, without a window over a ray.
    """
    enemy = pixels.where("owner <> circle").groupBy("circle", "ray").agg(F.min("d").alias("stop"))
    own = pixels.where("owner = circle").join(enemy, ["circle", "ray"], "left")
    return own.where("stop is null or d < stop").select("circle", "ray", "pixel", "d")


def shortest_path(edges: DataFrame, start: object, goal: object, blocked: DataFrame | None = None) -> DataFrame:
    """place, node, cost: a cheapest way over undirected edges (a, b, w) that touches no blocked node; no rows if there is none.

    Costs from the start come from the distributed relaxation; the way back takes one step a round, each a small join.
    Of equally cheap steps the smaller node counts.
    """
    if blocked is not None:
        out = blocked.select(F.col("node").alias("a"))
        edges = edges.join(out, "a", "left_anti").join(out.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b", "w")
    spark = edges.sparkSession
    kind = dict(edges.dtypes)["a"]
    seed = spark.range(1).select(F.lit(start).cast(kind).alias("node"), F.lit(0).alias("owner"))
    cost = materialize(graph.cheapest(edges, seed).select("node", "cost"))
    both = materialize(edges.select("a", "b", "w").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    way = [r for r in cost.where(F.col("node") == F.lit(goal)).collect()]
    while way and way[-1].node != start:
        here = way[-1]
        step = both.where(F.col("a") == F.lit(here.node)).join(cost.withColumnsRenamed({"node": "b", "cost": "c"}), "b").where(F.abs(F.col("c") + F.col("w") - F.lit(here.cost)) < 1e-9)
        way += step.select(F.col("b").alias("node"), F.col("c").alias("cost")).where(F.col("cost") < F.lit(here.cost)).orderBy("node").limit(1).collect()
        if way[-1] is here:
            raise RuntimeError("the way back ends; weights must be above 0")
    way.reverse()
    return spark.createDataFrame([(k, r.node, float(r.cost)) for k, r in enumerate(way)], f"place int, node {kind}, cost double")


def thinned(points: DataFrame, radius: float, max_rounds: int = 200) -> DataFrame:
    """Points (id, x, y) of which no two are nearer than radius, and none could be added: dart throwing in a hashed order.

    In a round each open point that has the smallest hash among the open ones in reach stays, and those in reach of it
    go. The result is that of throwing the points one by one in the order of their hashes; rounds are few. Two points of
    a cell are always in reach of each other, so only the first of each cell is held against the 25 cells around; pairs
    of points are never listed. A point without a place has none in reach and stays.
    """
    side = radius / 1.5
    rank = lambda i: F.struct(F.xxhash64(i).alias("h"), F.col(i).alias("i"))
    placed = points.where("x is not null and y is not null").select("x", "y", rank("id").alias("r"))
    # of points of one place all but the first go, whether it stays or goes
    open_ = materialize(placed.groupBy("x", "y").agg(F.min("r").alias("r")).select("x", "y", "r", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")))
    chosen = points.where("x is null or y is null").select("id")
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)])
    gap = (F.col("ax") - F.col("x")) * (F.col("ax") - F.col("x")) + (F.col("ay") - F.col("y")) * (F.col("ay") - F.col("y"))

    def in_reach(some: DataFrame) -> DataFrame:
        sent = some.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("r").alias("ar"), F.col("cx").alias("_x"), F.col("cy").alias("_y"), F.inline(around))
        sent = sent.select("ax", "ay", "ar", (F.col("_x") + F.col("i")).alias("cx"), (F.col("_y") + F.col("j")).alias("cy"))
        return open_.join(sent.hint("merge"), ["cx", "cy"]).where(gap < radius * radius)

    for _ in range(max_rounds):
        if open_.isEmpty():
            return points.join(chosen.hint("merge"), "id", "left_semi")
        first = open_.groupBy("cx", "cy").agg(F.min(F.struct("r", "x", "y")).alias("m")).select("m.*", "cx", "cy")
        won = materialize(first.join(in_reach(first).where("r < ar").select(F.col("ar").alias("r")).distinct().hint("merge"), "r", "left_anti"))
        chosen = chosen.union(won.select("r.i"))
        open_ = materialize(open_.join(in_reach(won).select("r").distinct().hint("merge"), "r", "left_anti"))
    raise RuntimeError(f"darts did not settle in {max_rounds} rounds")


def jittered_grid(spark, step: float, columns: int, rows: int, keep: Callable[[Column, Column], Column], seed: int = 0) -> DataFrame:
    """(id, x, y): a point in each place of a grid, moved inside it by a hash, kept where another hash is below keep(x, y)."""
    unit = lambda salt: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)
    g = spark.range(columns * rows).select("id", ((F.col("id") % columns + unit(1)) * step).alias("x"), (F.expr(f"id div {columns}") * step + unit(2) * step).alias("y"))
    return g.where(unit(3) < keep(F.col("x"), F.col("y"))).select("id", "x", "y")


def nearest_centre(points: DataFrame, centres: DataFrame) -> DataFrame:
    """points (x, y, ...) of different places with `id`, the nearest of centres (id, x, y) at any distance; the smallest id wins a tie.

    Cells begin as wide as centres are apart on average. What lies nearer than a cell's width is among the nine cells
    around a point; points without such a centre look again in cells twice as wide. Without centres there are no rows.
    """
    real = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    c = materialize(centres.where(real).groupBy("x", "y").agg(F.min("id").alias("id")))
    open_, done = materialize(points.where(real)), None
    b = c.agg(F.count("*").alias("n"), *[f(v).alias(f"{f.__name__}_{v}") for f in (F.min, F.max) for v in "xy"]).first()
    if not b.n:
        return open_.limit(0).crossJoin(centres.select("id").limit(0))
    w, h = b.max_x - b.min_x, b.max_y - b.min_y
    side = max((w * h / b.n) ** 0.5, max(w, h) / b.n) or 1.0
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    while True:
        at = lambda v: F.floor(F.col(v) / side)  # noqa: B023, E731
        t = c.select("id", F.col("x").alias("_x"), F.col("y").alias("_y"), at("x").alias("_i"), at("y").alias("_j"), F.inline(around))
        t = t.select("id", "_x", "_y", (F.col("_i") + F.col("i")).alias("cx"), (F.col("_j") + F.col("j")).alias("cy"))
        d = (F.col("x") - F.col("_x")) * (F.col("x") - F.col("_x")) + (F.col("y") - F.col("_y")) * (F.col("y") - F.col("_y"))
        near = open_.select("x", "y", at("x").alias("cx"), at("y").alias("cy")).join(t.hint("merge"), ["cx", "cy"])
        # a little less than the width, which rounding cannot reach
        best = near.select("x", "y", "id", d.alias("d")).where(F.col("d") < (0.999 * side) ** 2).groupBy("x", "y").agg(F.min(F.struct("d", "id"))["id"].alias("id"))
        found = materialize(open_.join(best.hint("merge"), ["x", "y"], "left"))
        own = found.where("id is not null")
        done = own if done is None else done.union(own)
        open_ = found.where("id is null").drop("id")
        if open_.isEmpty():
            return done
        side *= 2


def relaxed(points: DataFrame, centres: DataFrame, rounds: int) -> DataFrame:
    """centres (id, x, y) moved to the mean of the points (x, y) nearest to each, so many times; a centre without points stays.

    Points of one place are compared once and count as often as they are.
    """
    places = materialize(points.groupBy("x", "y").agg(F.count("*").alias("n")))
    for _ in range(rounds):
        own = nearest_centre(places, centres)
        mean = own.groupBy("id").agg(*[(F.sum(F.col(v) * F.col("n")) / F.sum("n")).alias(f"m{v}") for v in "xy"])
        centres = materialize(centres.join(mean.hint("merge"), "id", "left").select("id", F.coalesce("mx", "x").alias("x"), F.coalesce("my", "y").alias("y")))
    return centres


def ring_windows(points: DataFrame, ring: str, order: str, columns: tuple[str, ...]) -> DataFrame:
    """points with prev_ and next_ of columns along a closed ring: the first follows the last."""
    w, all_ = Window.partitionBy(ring).orderBy(order), Window.partitionBy(ring).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = points
    for c in columns:
        out = out.withColumn(f"prev_{c}", F.coalesce(F.lag(c).over(w), F.last(c).over(all_))).withColumn(f"next_{c}", F.coalesce(F.lead(c).over(w), F.first(c).over(all_)))
    return out


def island_filter(pieces: DataFrame, area: str, least: float, soft: Column, least_soft: float, names: DataFrame, countries: tuple, zone: Column, top: DataFrame) -> DataFrame:
    """pieces (name, country, area, ...) without the small ones that nothing protects.

    least holds outside of soft places, least_soft inside. Protected are listed names (name), countries and zones, and
    of countries in top (country, n) the pieces that bear the name of one of the n largest; names compare in lower case.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    ranked = pieces.join(top, "country").withColumn("_r", F.row_number().over(Window.partitionBy("country").orderBy(F.desc(area), "name")))
    best = ranked.where("_r <= n").select("country", low("name").alias("_best")).distinct()
    j = pieces.withColumn("_low", low("name"))
    j = j.join(names.select(low("name").alias("_low")).distinct().withColumn("_listed", F.lit(True)), "_low", "left")
    j = j.join(best.withColumnRenamed("_best", "_low").withColumn("_top", F.lit(True)), ["country", "_low"], "left")
    safe = F.coalesce("_listed", F.lit(False)) | F.coalesce("_top", F.lit(False)) | F.col("country").isin(*countries) | zone
    return j.where(safe | (F.col(area) >= F.when(soft, least_soft).otherwise(least))).select(pieces.columns)


def zone_shapes(atoms: DataFrame, sides: DataFrame) -> DataFrame:
    """zone, atoms, area, outline, compactness of zones that atoms (id, zone, area) add up to.

    sides are (a, b, length) between atoms, b null at the outside; those inside a zone are no outline.
    """
    of = lambda x: atoms.select(F.col("id").alias(x), F.col("zone").alias(f"z_{x}"))
    s = sides.join(of("a"), "a", "left").join(of("b"), "b", "left").where("not (z_a <=> z_b)")
    outline = s.select(F.col("z_a").alias("zone"), "length").union(s.select("z_b", "length")).where("zone is not null").groupBy("zone").agg(F.sum("length").alias("outline"))
    g = atoms.groupBy("zone").agg(F.count("*").alias("atoms"), F.sum("area").alias("area")).join(outline, "zone", "left")
    return g.select("zone", "atoms", "area", F.coalesce("outline", F.lit(0.0)).alias("outline"), geo.compactness(F.col("area"), F.coalesce("outline", F.lit(0.0))).alias("compactness"))


def split_quality(share: Column, wanted: Column, border: Column, total: Column, compact: tuple[Column, Column], radius: tuple[Column, Column], size: tuple[Column, Column]) -> Column:
    """How bad a division of pixels in two is: balance, border length, compactness and thinness, by fixed weights."""
    # Weights of balance, border, compactness and thinness, and the thickness below which a part is thin.
    balance, along, dense, thin, least = 6.0, 0.42, 0.70, 10.0, 0.12
    slack = sum((F.greatest(F.lit(0.0), F.lit(least) - r / F.greatest(F.sqrt(F.greatest(n, F.lit(1))), F.lit(1.0))) for r, n in zip(radius, size, strict=True)), F.lit(0.0))
    return F.abs(share - wanted) * balance + border / F.greatest(F.sqrt(total), F.lit(1.0)) * along + (2 - compact[0] - compact[1]) * dense + slack * thin
