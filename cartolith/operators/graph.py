"""Relational graph loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolith.runtime import drop_materialized, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id for every node that has an edge: columns node, component.

    Alternates large-star and small-star steps, which need a number of rounds that grows with the logarithm of the
    graph. Each step groups with map-side minima, writes them, and joins them back, so that a hub with a large share
    of all edges is split by the skew join. It ends when every node has either no smaller neighbour or one and no
    larger, which the minima show. Self-loops are ignored; an empty edge table gives no rows.
    """
    e = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    cur = materialize(e)
    for _ in range(max_rounds):
        both = cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(cur.select("hi", "lo"))
        mins = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.max("v").alias("top"), F.count_if(F.col("v") < F.col("u")).alias("below")))
        if mins.where("below > 1 or (below = 1 and top > u)").isEmpty():
            drop_materialized(mins)
            break
        large = both.where("v > u").join(mins.select("u", "m"), "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = materialize(large.where("lo < hi").distinct())
        low = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(low, "hi")
        small = small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).union(small.select("m", "hi")).where("lo < hi")
        new = materialize(small.distinct())
        drop_materialized(cur, mins, large, low)
        cur = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(cur.select("lo", "lo").distinct())


def _both_ways(edges: DataFrame, *more: str) -> DataFrame:
    return materialize(edges.select("a", "b", *more).union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), *more)).where("a <> b").distinct())


def grow(edges: DataFrame, seeds: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """node, owner, step for every node that seeds (node, owner) reach over undirected edges (a, b).

    All owners claim the free neighbours of what they got in the tick before; the lowest owner wins a tie. Each tick
    reads only the last frontier. step is also the number of hops to the nearest seed.
    """
    both = _both_ways(edges)
    front = materialize(seeds.groupBy("node").agg(F.min("owner").alias("owner")).withColumn("step", F.lit(0)))
    state = front
    for k in range(1, max_rounds + 1):
        claims = both.join(front.select(F.col("node").alias("a"), "owner"), "a").groupBy(F.col("b").alias("node")).agg(F.min("owner").alias("owner"))
        front = materialize(claims.join(state.select("node"), "node", "left_anti").select("node", "owner", F.lit(k).alias("step")))
        if not front.limit(1).count():
            return state
        state = state.union(front)
    raise RuntimeError(f"growth did not end in {max_rounds} rounds")


def cheapest(edges: DataFrame, seeds: DataFrame, max_rounds: int = 1000, steps: int | None = None) -> DataFrame:
    """node, owner, cost: the cheapest way from each seed (node, owner) over undirected edges (a, b, w), w above 0.

    Only nodes whose cost fell in the round before are relaxed again. With steps, the cheapest among ways of at most so
    many edges: a round adds one edge to the ways of the round before.
    """
    both = _both_ways(edges, "w")
    kind = dict(edges.dtypes)["w"]
    state = materialize(seeds.select("node", "owner", F.lit(0).cast(kind).alias("cost")).distinct())
    fell = state
    for _ in range(max_rounds if steps is None else steps):
        offers = both.join(fell.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node"), "owner").agg(F.min(F.col("cost") + F.col("w")).cast(kind).alias("cost"))
        known = state.select("node", "owner", F.col("cost").alias("old"))
        fell = materialize(offers.join(known, ["node", "owner"], "left").where("old is null or cost < old").select("node", "owner", "cost"))
        if not fell.limit(1).count():
            return state
        state = materialize(state.union(fell).groupBy("node", "owner").agg(F.min("cost").alias("cost")))
    if steps is not None:
        return state
    raise RuntimeError(f"costs did not settle in {max_rounds} rounds")


def biased_zones(costs: DataFrame, bias: DataFrame) -> DataFrame:
    """node, owner: for each node the owner of least cost - bias (owner, bias); the lowest owner wins a tie."""
    both = costs.join(bias, "owner")
    return both.groupBy("node").agg(F.min(F.struct((F.col("cost") - F.col("bias")).alias("d"), "owner")).alias("m")).select("node", F.col("m.owner").alias("owner"))


def spread_seeds(points: DataFrame, first: int, n: int) -> list[int]:
    """Ids of n points (id, x, y): first, then always the one farthest from those chosen; the smallest id wins a tie.

    n passes over points, each an aggregate of one row; nothing is kept but the n chosen points.
    """
    chosen = points.where(F.col("id") == first).select("id", "x", "y").limit(1).collect()
    while len(chosen) < n:
        far = F.least(F.lit(float("inf")), *[(F.col("x") - p.x) * (F.col("x") - p.x) + (F.col("y") - p.y) * (F.col("y") - p.y) for p in chosen])
        chosen += points.agg(F.max(F.struct(far.alias("d"), (-F.col("id")).alias("back"), "id", "x", "y")).alias("m")).select("m.id", "m.x", "m.y").collect()
    return [p.id for p in chosen]
