"""Cutting, dividing and describing rings (array<struct<x,y>>), as expressions over whole rings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cartolith.functions import geo

RING = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def cut_by_line(ring: Column, nx: Column, ny: Column, c: Column) -> Column:
    """The part of a ring where nx * x + ny * y >= c. Exact for convex rings; others may keep bridges along the line."""
    side = lambda p: nx * p["x"] + ny * p["y"] - c

    def kept(a: Column, b: Column) -> Column:
        none = F.slice(F.array(a), 1, 0)
        t = side(a) / F.when(side(a) != side(b), side(a) - side(b))
        met = F.struct((a["x"] + (b["x"] - a["x"]) * t).alias("x"), (a["y"] + (b["y"] - a["y"]) * t).alias("y"))
        return F.concat(F.when(side(a) >= 0, F.array(a)).otherwise(none), F.when((side(a) >= 0) != (side(b) >= 0), F.array(met)).otherwise(none))

    return _let(ring, lambda r: F.flatten(F.zip_with(r, geo._next(r), kept)))


def clipped(ring: Column, convex: Column) -> Column:
    """A ring's part inside a convex ring of positive direction (counter-clockwise with y up)."""
    sides = F.zip_with(convex, geo._next(convex), lambda a, b: F.struct((a["y"] - b["y"]).alias("nx"), (b["x"] - a["x"]).alias("ny"), ((a["y"] - b["y"]) * a["x"] + (b["x"] - a["x"]) * a["y"]).alias("c")))
    return F.aggregate(sides, ring, lambda r, s: cut_by_line(r, s["nx"], s["ny"], s["c"]))


def voronoi_cell(x: Column, y: Column, others: Column, frame: Column) -> Column:
    """The part of a frame that is nearer to (x, y) than to any of others (array of struct(x, y))."""
    nearer = lambda r, q: cut_by_line(r, x - q["x"], y - q["y"], (x * x + y * y - q["x"] * q["x"] - q["y"] * q["y"]) / 2)
    return F.aggregate(F.filter(others, lambda q: (q["x"] != x) | (q["y"] != y)), frame, nearer)


def area_cut(ring: Column, nx: float, ny: float, share: Column, steps: int = 32) -> Column:
    """struct(c, one, other): the line across a direction that leaves a share of the area in front, by bisection."""
    size = lambda r: F.abs(geo.shoelace(r)) / 2
    at = lambda r: F.transform(r, lambda p: nx * p["x"] + ny * p["y"])
    start = F.struct(F.array_min(at(ring)).alias("lo"), F.array_max(at(ring)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        return _let((s["lo"] + s["hi"]) / 2, lambda m: F.when(size(cut_by_line(ring, F.lit(nx), F.lit(ny), m)) > share * size(ring), F.struct(m.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi"))))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: (s["lo"] + s["hi"]) / 2)
    return _let(found, lambda c: F.struct(c.alias("c"), cut_by_line(ring, F.lit(nx), F.lit(ny), c).alias("one"), cut_by_line(ring, F.lit(-nx), F.lit(-ny), -c).alias("other")))


def least_box(ring: Column) -> Column:
    """struct(area, long, short, aspect) of the least box in any direction around a ring.

    A side of the least box lies along a side of the hull, and that joins two corners: all pairs of corners are tried,
    so the time grows with the cube of their number; simplify long rings first.
    """

    def box(a: Column, b: Column) -> Column:
        d = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        ux, uy = (b["x"] - a["x"]) / d, (b["y"] - a["y"]) / d
        span = lambda px, py: F.array_max(F.transform(ring, lambda p: p["x"] * px + p["y"] * py)) - F.array_min(F.transform(ring, lambda p: p["x"] * px + p["y"] * py))
        return F.struct(span(ux, uy).alias("u"), span(-uy, ux).alias("v"))

    pairs = F.flatten(F.transform(ring, lambda a: F.transform(F.filter(ring, lambda b: (b["x"] != a["x"]) | (b["y"] != a["y"])), lambda b: box(a, b))))
    least = F.array_min(F.transform(pairs, lambda s: F.struct((s["u"] * s["v"]).alias("area"), F.greatest(s["u"], s["v"]).alias("long"), F.least(s["u"], s["v"]).alias("short"))))
    return _let(least, lambda s: F.struct(s["area"], s["long"], s["short"], (s["long"] / F.greatest(s["short"], F.lit(0.001))).alias("aspect")))


def interpolated(knots: Column, x: Column) -> Column:
    """Straight lines between knots (array of struct(x, y), x rising), level beyond the ends."""
    before, after = F.filter(knots, lambda k: k["x"] <= x), F.filter(knots, lambda k: k["x"] > x)
    a, b = F.element_at(F.when(F.size(before) > 0, before), -1), F.get(after, F.lit(0))
    return F.when(F.size(before) == 0, b["y"]).when(F.size(after) == 0, a["y"]).otherwise(a["y"] + (b["y"] - a["y"]) * (x - a["x"]) / (b["x"] - a["x"]))


def simplified(points: Column, tolerance: float) -> Column:
    """An open line without the points that are within tolerance of what is left (split at the farthest point, again and again).

    Python over Arrow: which point splits depends on the splits before it, which no built-in expression can follow.
    """

    def one(line) -> list[dict]:
        p = np.array([(q["x"], q["y"]) for q in line], float).reshape(-1, 2)
        keep = np.zeros(len(p), bool)
        todo = [(0, len(p) - 1)] if len(p) > 1 else []
        keep[[0, -1] if len(p) else []] = True
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            d, q = p[b] - p[a], p[a + 1 : b] - p[a]
            n = d @ d
            t = np.clip(q @ d / n, 0, 1) if n else np.zeros(len(q))
            far = np.hypot(*(q - t[:, None] * d).T)
            k = int(far.argmax())
            if far[k] > tolerance:
                keep[a + 1 + k] = True
                todo += [(a, a + 1 + k), (a + 1 + k, b)]
        return [{"x": x, "y": y} for x, y in p[keep]]

    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda v: None if v is None else one(v))

    return F.pandas_udf(run, RING)(points)


def roughened(points: Column, share: float, rounds: int = 3) -> Column:
    """An open line with the middles of its legs moved sideways by up to a share of their length, again in each round.

    How far is a hash of the leg's two ends in sorted order, so that a line and its reverse move alike.
    """
    for _ in range(rounds):
        points = _let(points, lambda v: F.concat(F.flatten(F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.array(a, _middle(a, b, share)))), F.slice(v, -1, 1)))
    return points


def _middle(a: Column, b: Column, share: float) -> Column:
    first = (a["x"] < b["x"]) | ((a["x"] == b["x"]) & (a["y"] <= b["y"]))
    p, q = F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)
    unit = F.pmod(F.xxhash64(p["x"], p["y"], q["x"], q["y"]), F.lit(1 << 20)) / float(1 << 19) - 1
    return F.struct(((a["x"] + b["x"]) / 2 - (q["y"] - p["y"]) * unit * share).alias("x"), ((a["y"] + b["y"]) / 2 + (q["x"] - p["x"]) * unit * share).alias("y"))
