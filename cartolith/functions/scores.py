"""Rules of thumb of the map as column expressions: factors, costs, classes, counts and scores."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartolith.functions.geo import clamp, half_up, km_per_px

# How much of the land of a relief is settled, and how much a kind of development bears.
SETTLEMENT = {"fertile_plain": 1.20, "plain": 1.00, "hills": 0.75, "mountains": 0.25, "tundra": 0.10, "marsh": 0.05, "desert": 0.03}
DEVELOPMENT = {
    "none": 0.05, "sparse_settlement": 0.20, "hunting_grounds": 0.15, "pasture": 0.50, "villages": 1.00, "farmland": 1.30, "fertile_farmland": 1.50, "irrigated_fields": 1.80, "rice_paddies": 2.20,
    "vineyards": 0.90, "olive_groves": 0.80, "orchards": 1.10, "forestry": 0.40, "mining": 0.60, "quarry": 0.40, "salt_works": 0.50, "urban_periphery": 2.00,
}
# Base area, its factor's limits, a day's march, a cost's limits, the least people of a settled cell.
BASE_AREA_KM2, AREA_FACTOR, MARCH_KM, MOVE_COST, LEAST_PEOPLE = 1000.0, (0.4, 4.0), 40.0, (0.5, 5.0), 300
# Upper limits of the distance classes; the tiers' highest ranks; areas of lakes; seed bands.
DISTANCE_CLASSES = ((90, "coastal"), (220, "dense_sea"), (500, "regional_sea"))
RIVER_RANKS, LAKE_LEAST_KM2, LAKE_LARGE_KM2 = (2, 5, 8), 15.0, 500.0
SEED_BANDS_KM, SEED_REACH = (90.0, 240.0), ((1.25, 1.0), (2.75, 0.72), (5.5, 0.46))
# From which aspect, or below which compactness, a shape counts as so much more complex.
SHAPES = ((3.0, 0.22, 1.18), (2.0, 0.38, 1.12), (1.45, 0.58, 1.05))


def _looked_up(key: Column, values: dict[str, float], otherwise: float) -> Column:
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return F.coalesce(out, F.lit(otherwise))


def area_factor(area_km2: Column) -> Column:
    return clamp(F.sqrt(F.greatest(area_km2, F.lit(0.0)) / BASE_AREA_KM2), *AREA_FACTOR)


def settlement_factor(relief: Column) -> Column:
    return _looked_up(relief, SETTLEMENT, 1.0)


def development_factor(kind: Column) -> Column:
    return _looked_up(kind, DEVELOPMENT, DEVELOPMENT["none"])


def rural_capacity(area_km2: Column, density: Column, relief: Column, kind: Column, infrastructure: Column, health: Column, security: Column) -> Column:
    return area_km2 * density * settlement_factor(relief) * development_factor(kind) * infrastructure * health * security


def rural_population(capacity: Column, maturity: Column, kind: Column) -> Column:
    """Rounded capacity by maturity; settled cells have at least LEAST_PEOPLE."""
    people = F.round(capacity * maturity)
    return F.when(kind != "none", F.greatest(people, F.lit(float(LEAST_PEOPLE)))).otherwise(people).cast("long")


def movement_cost(distance_km: Column, *modifiers: Column) -> Column:
    cost = distance_km / MARCH_KM
    for m in modifiers:
        cost = cost * m
    return clamp(cost, *MOVE_COST)


def control_cost(factor: Column, *modifiers: Column) -> Column:
    """Product of the area factor and all modifiers, without limits."""
    for m in modifiers:
        factor = factor * m
    return factor


def distance_class(distance_km: Column) -> Column:
    out = F.lit("ocean_transition")
    for limit, name in reversed(DISTANCE_CLASSES):
        out = F.when(distance_km <= limit, F.lit(name)).otherwise(out)
    return out


def seed_size(distance_px: Column, y: Column, base: float, coastal: float, shelf: float, open_sea: float) -> Column:
    """Wanted cell size at a distance from land: small at the coast, at least open_sea beyond the shelf."""
    km = distance_px * km_per_px(y)
    return F.when(km <= SEED_BANDS_KM[0], F.lit(min(base, coastal))).when(km <= SEED_BANDS_KM[1], F.lit(min(base, shelf))).otherwise(F.lit(max(base, open_sea)))


def seed_keep(distance_px: Column, size: Column, step: float) -> Column:
    """Chance that a scanned place becomes a seed."""
    ratio = F.lit(step) / F.greatest(size * 0.86, F.lit(1.0))
    chance = clamp(ratio * ratio, 0.10, 1.0)
    out = chance
    for reach, least in reversed(SEED_REACH):
        out = F.when(distance_px <= size * reach, F.greatest(chance, F.lit(least))).otherwise(out)
    return out


def river_tier(rank: Column) -> Column:
    """0, 1 or 2, and null beyond the last rank."""
    out = F.lit(None).cast("int")
    for tier, limit in reversed(list(enumerate(RIVER_RANKS))):
        out = F.when(rank <= limit, F.lit(tier)).otherwise(out)
    return out


def lake_tier(total_km2: Column) -> Column:
    """By the summed area of a lake's parts; small lakes are null."""
    return F.when(total_km2 >= LAKE_LARGE_KM2, F.lit("large")).when(total_km2 >= LAKE_LEAST_KM2, F.lit("small"))


def expected_cells(area_km2: Column, target: Column, least: Column, most: Column) -> Column:
    """Half-up area / target within its limits; null without a target."""
    n = F.greatest(half_up(area_km2 / target), F.coalesce(least, F.lit(1)))
    return F.when(target > 0, F.when(most.isNotNull(), F.least(n, most)).otherwise(n)).cast("long")


def overridden(base: Column, forced: Column, minimum: Column) -> Column:
    return F.when(forced.isNotNull(), forced).otherwise(F.when(base.isNotNull() & minimum.isNotNull(), F.greatest(base, minimum)).otherwise(base))


def shape_factor(aspect: Column, compactness: Column) -> Column:
    out = F.lit(1.0)
    for ratio, dense, factor in reversed(SHAPES):
        out = F.when((aspect >= ratio) | (compactness < dense), F.lit(factor)).otherwise(out)
    return out


def complex_count(area_km2: Column, target: Column, shape: Column, coastal: Column, anchor: Column, least: Column, most: Column, forced: Column) -> Column:
    """Cells by area and complexity: banker's rounding, then the anchor, the limits and a forced number."""
    wanted = F.greatest(F.lit(1.0), F.bround(area_km2 / target * clamp(F.when(coastal, 1.05).otherwise(1.0) * shape, 0.85, 1.35)))
    return F.coalesce(forced, F.greatest(least, F.least(most, F.greatest(wanted, F.greatest(F.lit(1), F.coalesce(anchor, F.lit(1))))))).cast("long")


def score_inverse(value: Column, good: float, bad: float) -> Column:
    """100 up to good, 0 from bad on, a straight line between."""
    return F.when(value <= good, 100.0).when(value >= bad, 0.0).otherwise(100.0 * (F.lit(bad) - value) / (bad - good))


def score_direct(value: Column, bad: float, good: float) -> Column:
    """0 up to bad, 100 from good on, a straight line between."""
    return F.when(value <= bad, 0.0).when(value >= good, 100.0).otherwise(100.0 * (value - bad) / (good - bad))


def scaled_area(area_px: Column, y: Column) -> Column:
    """Area by the scale at one row: pixels times the square of a pixel's km."""
    return area_px * km_per_px(y) * km_per_px(y)


def shared_area(parent_km2: Column, part: Column, whole: Column) -> Column:
    """A part's share of its parent's known area."""
    return F.when(whole > 0, parent_km2 * part / whole).otherwise(F.lit(0.0))


def smoothstep(low: float, high: float, x: Column) -> Column:
    t = clamp((x - low) / (high - low), 0.0, 1.0)
    return t * t * (3 - 2 * t)


def golden_hue(index: Column) -> Column:
    """Hues that stay apart: steps of the golden ratio around the circle."""
    turn = index * ((math.sqrt(5) - 1) / 2)
    return turn - F.floor(turn)
