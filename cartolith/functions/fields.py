"""Fields over the plane and the camera: noise, warps, colour ramps, levels of detail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The integer hash, the warp's waves, the world, the tiles and the polar limits.
MIX = (374761393, 668265263, 1442695041, 1274126177)
WORLD, TILE, LEVELS, PAD, HYSTERESIS = 8192, 256, 7, 1, 0.15
NORTH, SOUTH = 1361.5, 5724.7
MASK = 0xFFFFFFFF


def cell_noise(ix: Column, iy: Column, salt: int) -> Column:
    """A number in 0..1 for an integer cell; cells within 2^32 of the origin."""
    v = (ix * MIX[0] + iy * MIX[1] + F.lit(salt * MIX[2])).bitwiseAND(F.lit(MASK))
    v = (v.bitwiseXOR(F.shiftright(v, 13)) * MIX[3]).bitwiseAND(F.lit(MASK))
    return v.bitwiseXOR(F.shiftright(v, 16)) / float(MASK)


def smoothstep(t: Column) -> Column:
    return t * t * (F.lit(3.0) - t * 2.0)


def value_noise(x: Column, y: Column, scale: float, salt: int) -> Column:
    """Noise in -1..1, smooth between the corners of cells of that scale."""
    gx, gy = x / scale, y / scale
    cx, cy = F.floor(gx), F.floor(gy)
    tx, ty = smoothstep(gx - cx), smoothstep(gy - cy)
    rows = []
    for dy in (0, 1):
        left, right = (cell_noise(cx + dx, cy + dy, salt) for dx in (0, 1))
        rows.append(left + (right - left) * tx)
    return (rows[0] + (rows[1] - rows[0]) * ty) * 2.0 - 1.0


def sine_noise(x: Column, y: Column, salt: int) -> Column:
    v = F.sin(x * 12.9898 + y * 78.233 + F.lit(salt * 37.719)) * 43758.5453
    return (v - F.floor(v)) * 2.0 - 1.0


def warp(x: Column, y: Column, amplitude: float) -> tuple[Column, Column]:
    """Coordinates moved by slow waves and a little noise."""
    slow_x = F.sin(x * 0.019 + y * 0.011 + 1.7) + F.sin(x * 0.041 - y * 0.017 + 4.1) * 0.45
    slow_y = F.cos(x * 0.013 - y * 0.023 + 2.9) + F.sin(x * 0.027 + y * 0.037 + 5.3) * 0.45
    fine = [sine_noise(x * 0.075, y * 0.075, salt) * 0.45 for salt in (11, 23)]
    return x + (slow_x + fine[0]) * amplitude, y + (slow_y + fine[1]) * amplitude


def depth_color(depth: Column, stops: list[tuple[int, int, int]], most: float, gamma: float, middle: float, abyss_at: float) -> list[Column]:
    """Red, green and blue of a depth: shelf to mid to deep along a curve, abyss from abyss_at; unknown is shelf."""
    shelf, mid, deep, abyss = stops
    t = F.pow(F.least(F.greatest(F.coalesce(depth, F.lit(0.0)), F.lit(0.0)), F.lit(most)) / most, F.lit(gamma))
    out = []
    for a, b, c, z in zip(shelf, mid, deep, abyss, strict=True):
        v = F.when(t < middle, F.lit(float(a)) + t / middle * (b - a)).otherwise(F.lit(float(b)) + (t - middle) / (1 - middle) * (c - b))
        out.append(F.floor(F.when(depth >= abyss_at, F.lit(float(z))).otherwise(v)).cast("int"))
    return out


def lod_of(zoom: Column) -> Column:
    """The exact, fractional level of detail of a camera's zoom."""
    return F.log2(zoom * float(WORLD) / TILE)


def _within(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(x, high)).cast("int")


def whole_lod(lod: Column) -> Column:
    return _within(F.round(lod), F.lit(0), F.lit(LEVELS))


def next_lod(now: Column, lod: Column) -> Column:
    """The level to show: the one before, until the exact level has left it by half a level and the hysteresis."""
    return F.when(now.isNull() | (F.abs(lod - now) > 0.5 + HYSTERESIS), whole_lod(lod)).otherwise(now)


def visible_tiles(x: Column, y: Column, width: Column, height: Column, lod: Column) -> list[Column]:
    """First and last tile column and row of a view with this centre, padded, without the polar rows."""
    n = F.pow(F.lit(2.0), lod)
    size, last = F.lit(float(WORLD)) / n, n - 1
    north, south = _within(F.floor(F.lit(NORTH) / size), F.lit(0), last), _within(F.ceil(F.lit(SOUTH) / size), F.lit(0), last)
    out = []
    for side, pad in ((-0.5, -PAD), (0.5, PAD)):
        out += [_within(F.floor((x + width * side) / size) + pad, F.lit(0), last), _within(F.floor((y + height * side) / size) + pad, north, south)]
    return out
