"""Column expressions on a Web Mercator world square and on rings. A ring is array<struct<x,y>>."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WORLD_PX = 8192.0
MAX_LAT = 85.05112878


def to_world(lon: Column, lat: Column, size: float = WORLD_PX) -> tuple[Column, Column]:
    """World pixels of a position; latitude is clamped to the square."""
    phi = F.radians(F.greatest(F.lit(-MAX_LAT), F.least(F.lit(MAX_LAT), lat)))
    return (lon + 180) / 360 * size, (0.5 - F.ln(F.tan(F.lit(math.pi / 4) + phi / 2)) / (2 * math.pi)) * size


def to_lonlat(x: Column, y: Column, size: float = WORLD_PX) -> tuple[Column, Column]:
    n = F.lit(math.pi) * (1 - 2 * y / size)
    return x / size * 360 - 180, F.degrees(F.atan(F.sinh(n)))


def km_per_px(y: Column, radius_km: float = 6371.0, size: float = WORLD_PX) -> Column:
    return 2 * math.pi * radius_km / size * F.cos(F.radians(to_lonlat(F.lit(0.0), y, size)[1]))


def _next(ring: Column) -> Column:
    """The ring's points, each moved up by one."""
    return F.concat(F.slice(ring, F.lit(2), F.greatest(F.lit(0), F.size(ring) - 1)), F.slice(ring, 1, 1))


def shoelace(ring: Column) -> Column:
    """Signed double area."""
    return F.aggregate(F.zip_with(ring, _next(ring), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, v: s + v)


def perimeter(ring: Column) -> Column:
    return F.aggregate(F.zip_with(ring, _next(ring), lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"])), F.lit(0.0), lambda s, v: s + v)


def ring_area_km2(ring: Column, radius_km: float = 6371.0) -> Column:
    """Area of a lon/lat ring on a plane around the mean latitude of the listed points."""
    mean = F.aggregate(F.transform(ring, lambda p: p["y"]), F.lit(0.0), lambda s, v: s + v) / F.size(ring)
    k = math.pi / 180 * radius_km
    return F.abs(shoelace(ring)) / 2 * k * k * F.cos(F.radians(mean))


def polygon_area(rings: Column, area=ring_area_km2) -> Column:
    """Outer ring less its holes, not below 0."""
    holes = F.aggregate(F.transform(F.slice(rings, F.lit(2), F.greatest(F.lit(0), F.size(rings) - 1)), lambda r: area(r)), F.lit(0.0), lambda s, v: s + v)
    return F.greatest(F.lit(0.0), area(rings[0]) - holes)


def compactness(area: Column, length: Column) -> Column:
    return F.when(length > 0, 4 * math.pi * area / (length * length)).otherwise(F.lit(0.0))


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule."""
    crossed = F.zip_with(ring, _next(ring), lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"]), 1).otherwise(0))
    return F.aggregate(crossed, F.lit(0), lambda s, v: s + v) % 2 == 1


def in_polygon(rings: Column, x: Column, y: Column) -> Column:
    """Inside the outer ring and in none of its holes."""
    holes = F.slice(rings, F.lit(2), F.greatest(F.lit(0), F.size(rings) - 1))
    return in_ring(rings[0], x, y) & ~F.exists(holes, lambda r: in_ring(r, x, y))


def chaikin(points: Column) -> Column:
    """One round of corner cutting on a closed ring."""
    part = lambda a, b, t: F.struct((a["x"] * (1 - t) + b["x"] * t).alias("x"), (a["y"] * (1 - t) + b["y"] * t).alias("y"))
    return F.flatten(F.zip_with(points, _next(points), lambda a, b: F.array(part(a, b, 0.25), part(a, b, 0.75))))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length))).otherwise(F.lit(0.0))
    u, v = px - ax - t * dx, py - ay - t * dy
    return F.sqrt(u * u + v * v)


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def centroid(ring: Column) -> Column:
    """Centre of mass of a ring of either direction as struct(x, y, area); null for a ring without area."""
    cross = F.zip_with(ring, _next(ring), lambda a, b: F.struct((a["x"] * b["y"] - b["x"] * a["y"]).alias("c"), (a["x"] + b["x"]).alias("x"), (a["y"] + b["y"]).alias("y")))
    zero = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(cross, zero, lambda s, v: F.struct((s["c"] + v["c"]).alias("c"), (s["x"] + v["x"] * v["c"]).alias("x"), (s["y"] + v["y"] * v["c"]).alias("y")))
    return F.get(F.transform(F.array(total), lambda t: F.when(t["c"] != 0, F.struct((t["x"] / (3 * t["c"])).alias("x"), (t["y"] / (3 * t["c"])).alias("y"), (F.abs(t["c"]) / 2).alias("area")))), F.lit(0))


#: Fixed values of the WGS84 ellipsoid: half axis in km and flattening.
WGS84_A, WGS84_F = 6378.137, 1 / 298.257223563


def _authalic(lat: Column) -> tuple[Column, float]:
    """Sine of the authalic latitude: on a sphere of equal surface it encloses the same area."""
    e2 = WGS84_F * (2 - WGS84_F)
    e = math.sqrt(e2)
    q = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    pole = (1 - e2) * (1 / (1 - e2) - math.log((1 - e) / (1 + e)) / (2 * e))
    return q(F.sin(F.radians(lat))) / pole, pole


def geodesic_area_km2(ring: Column) -> Column:
    """Area of a lon/lat ring on the WGS84 ellipsoid, 0 for fewer than 4 listed points (a closed triangle has 4).

    Edges are great circles of the authalic sphere; for edges of map polygons the difference to geodesics is far below a
    millionth. Rings that hold a pole or cross the date line are not meant.
    """
    _, pole = _authalic(F.lit(0.0))
    r2 = WGS84_A * WGS84_A * pole / 2
    beta = lambda p: F.asin(_authalic(p["y"])[0])
    points = F.transform(ring, lambda p: F.struct(F.radians(p["x"]).alias("l"), F.tan(beta(p) / 2).alias("t")))
    part = lambda a, b: 2 * F.atan2(F.tan((b["l"] - a["l"]) / 2) * (a["t"] + b["t"]), 1 + a["t"] * b["t"])
    total = F.get(F.transform(F.array(points), lambda ps: F.aggregate(F.zip_with(ps, _next(ps), part), F.lit(0.0), lambda s, v: s + v)), F.lit(0))
    return F.when(F.size(ring) < 4, F.lit(0.0)).otherwise(F.abs(total) * r2)


def bbox(ring: Column) -> Column:
    get = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    return F.struct(get(F.array_min, "x").alias("x0"), get(F.array_min, "y").alias("y0"), get(F.array_max, "x").alias("x1"), get(F.array_max, "y").alias("y1"))


def densify(points: Column, longest: float) -> Column:
    """An open line with points between, so that no step is longer; a closed ring lists its first point again."""
    after = lambda a, b: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.hypot(b["x"] - a["x"], b["y"] - a["y"]) / longest).cast("int"))), lambda i: F.struct((a["x"] + (b["x"] - a["x"]) * i / F.greatest(F.lit(1), F.ceil(F.hypot(b["x"] - a["x"], b["y"] - a["y"]) / longest))).alias("x"), (a["y"] + (b["y"] - a["y"]) * i / F.greatest(F.lit(1), F.ceil(F.hypot(b["x"] - a["x"], b["y"] - a["y"]) / longest))).alias("y")))
    n = F.size(points)
    steps = F.flatten(F.zip_with(F.slice(points, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(points, F.lit(2), F.greatest(n - 1, F.lit(0))), after))
    return F.when(n < 2, points).otherwise(F.concat(F.slice(points, 1, 1), steps))


def line_character(points: Column) -> Column:
    """struct(sinuosity, deviation): length over chord, and the farthest a point is off the chord; infinite for closed lines."""
    n = F.size(points)
    a, b = F.get(points, F.lit(0)), F.get(points, n - 1)
    chord = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    length = F.aggregate(F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"])), F.lit(0.0), lambda s, v: s + v)
    off = F.array_max(F.transform(points, lambda p: F.abs((b["x"] - a["x"]) * (a["y"] - p["y"]) - (a["x"] - p["x"]) * (b["y"] - a["y"]))))
    inf = F.lit(float("inf"))
    said = F.when(chord > 1e-9, F.struct((length / chord).alias("sinuosity"), (off / chord).alias("deviation"))).otherwise(F.struct(inf.alias("sinuosity"), inf.alias("deviation")))
    return F.when(n < 2, F.struct(F.lit(1.0).alias("sinuosity"), F.lit(0.0).alias("deviation"))).otherwise(said)


def cut_below(ring: Column, axis: str, bound: float, keep_above: bool = True) -> Column:
    """The part of a ring on one side of a line x = bound or y = bound; two cuts on y are a latitude band."""
    inside = lambda p: (p[axis] >= bound) if keep_above else (p[axis] <= bound)
    other = "y" if axis == "x" else "x"

    def crossing(a: Column, b: Column) -> Column:
        at = a[other] + (b[other] - a[other]) * (bound - a[axis]) / (b[axis] - a[axis])
        pair = {axis: F.lit(float(bound)), other: at}
        return F.struct(pair["x"].alias("x"), pair["y"].alias("y"))

    def kept(a: Column, b: Column) -> Column:
        none = F.slice(F.array(a), 1, 0)
        return F.concat(F.when(inside(a), F.array(a)).otherwise(none), F.when(inside(a) != inside(b), F.array(crossing(a, b))).otherwise(none))

    return F.flatten(F.zip_with(ring, _next(ring), kept))


def row_spans(rings: Column, y: Column) -> Column:
    """Where a horizontal line is inside a polygon with holes: array of struct(x0, x1), by the even-odd rule."""
    hits = lambda r: F.zip_with(r, _next(r), lambda a, b: F.when((a["y"] > y) != (b["y"] > y), (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"]))
    xs = F.array_sort(F.array_compact(F.flatten(F.transform(rings, hits))))
    pairs = lambda v: F.transform(F.sequence(F.lit(0), (F.size(v) / 2).cast("int") - 1), lambda i: F.struct(F.get(v, 2 * i).alias("x0"), F.get(v, 2 * i + 1).alias("x1")))
    return F.get(F.transform(F.array(xs), lambda v: F.when(F.size(v) > 1, pairs(v)).otherwise(F.slice(F.transform(v, lambda x: F.struct(x.alias("x0"), x.alias("x1"))), 1, 0))), F.lit(0))


def inner_point(rings: Column) -> Column:
    """A point that is inside for sure: the middle of the widest span of the row halfway up the outer ring."""
    ys = F.transform(F.get(rings, F.lit(0)), lambda p: p["y"])
    middle = (F.array_min(ys) + F.array_max(ys)) / 2
    best = lambda spans: F.array_max(F.transform(spans, lambda s: F.struct((s["x1"] - s["x0"]).alias("w"), (-s["x0"]).alias("back"), ((s["x0"] + s["x1"]) / 2).alias("x"))))
    return F.struct(best(row_spans(rings, middle))["x"].alias("x"), middle.alias("y"))


def along(points: Column, step: float) -> Column:
    """Points at equal steps along an open line, the last one its end, with the direction there: struct(x, y, tx, ty)."""
    n = F.size(points)
    legs = F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"), F.hypot(b["x"] - a["x"], b["y"] - a["y"]).alias("d")))
    legs = F.filter(legs, lambda leg: leg["d"] > 0)

    def sampled(legs: Column) -> Column:
        far = lambda i: F.aggregate(F.slice(legs, F.lit(1), i), F.lit(0.0), lambda s, v: s + v["d"])
        place = lambda leg, t: F.struct((leg["a"]["x"] + (leg["b"]["x"] - leg["a"]["x"]) * t).alias("x"), (leg["a"]["y"] + (leg["b"]["y"] - leg["a"]["y"]) * t).alias("y"), ((leg["b"]["x"] - leg["a"]["x"]) / leg["d"]).alias("tx"), ((leg["b"]["y"] - leg["a"]["y"]) / leg["d"]).alias("ty"))
        first = lambda before: F.ceil(before / step).cast("int")
        own = lambda leg, before: F.when(first(before) * step < before + leg["d"], F.transform(F.sequence(first(before), F.greatest(first(before), F.ceil((before + leg["d"]) / step).cast("int") - 1)), lambda k: place(leg, (k * step - before) / leg["d"]))).otherwise(F.slice(F.array(place(leg, F.lit(0.0))), 1, 0))
        every = F.flatten(F.transform(legs, lambda leg, i: own(leg, far(i))))
        return F.concat(every, F.array(place(F.get(legs, F.size(legs) - 1), F.lit(1.0))))

    return F.get(F.transform(F.array(legs), lambda v: F.when(F.size(v) > 0, sampled(v))), F.lit(0))


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of two longs, by Euclid; 0 for two zeros."""
    start = F.struct(F.abs(a).alias("a"), F.abs(b).alias("b"))
    step = lambda s, _: F.struct(F.when(s["b"] == 0, s["a"]).otherwise(s["b"]).alias("a"), F.when(s["b"] == 0, F.lit(0)).otherwise(s["a"] % F.when(s["b"] == 0, F.lit(1)).otherwise(s["b"])).cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(46)), start, step)["a"]
