"""Price, experience, capture and guard rules of the domain as column expressions, with their constants as parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules: the radius without a surcharge, the factor where nobody makes a thing, the step of experience, the
# bounds of the power ratio, and the weapon prices.
FREE_RADIUS, NO_PRODUCER, XP_STEP = 50.0, 0.2, 20
RATIO_BOUNDS = (0.2, 2.0)
WEAPON_BASE, WEAPON_TIER, WEAPON_RARITY = 10, 10, {1: 20, 2: 30}


def distance_price_factor(distance: Column, over: float, power: float) -> Column:
    """What distance to the nearest producer adds to a price of 1; a null distance says that there is no producer."""
    return F.when(distance.isNull(), NO_PRODUCER).otherwise(F.pow(F.greatest(distance - FREE_RADIUS, F.lit(0.0)) / over, F.lit(power)))


def local_price(price: Column, distance: Column, over: float, power: float) -> Column:
    return price * (1 + distance_price_factor(distance, over, power))


def next_level_xp(value: Column, scale: Column) -> Column:
    """Experience to the next level: a level's value times its class's scale (null: 1), up to a multiple of XP_STEP."""
    return (F.ceil(value * F.coalesce(scale, F.lit(1.0)) / XP_STEP) * XP_STEP).cast("bigint")


def xp_ratio(average_power: Column, power: float) -> Column:
    low, high = RATIO_BOUNDS
    return F.greatest(F.lit(low), F.least(F.lit(high), F.pow(average_power, F.lit(power))))


def capture_chance(health: Column, full_at: float, least_at: float, most: float, least: float) -> Column:
    """From ``most`` at full_at (share of health) and below to ``least`` at least_at and above, by the root of what lies between."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (health - full_at) / (least_at - full_at)))
    return most + F.sqrt(t) * (least - most)


def guard_left(guard: Column, bonus: Column, pierce: Column, backstab: Column, most: int, backstab_ignores: int) -> Column:
    """Guard that counts: capped, less its pierced percentage rounded up, less a fixed part from behind, 0 at least."""
    capped = F.least(guard + bonus, F.lit(most))
    pierced = capped - F.ceil(capped * pierce / 100)
    return F.greatest(pierced - F.when(backstab, backstab_ignores).otherwise(0), F.lit(0)).cast("bigint")


def weapon_price(tier: Column, rarity: Column) -> Column:
    extra = F.coalesce(*[F.when(rarity == r, p) for r, p in WEAPON_RARITY.items()], F.lit(0))
    return WEAPON_BASE + tier * WEAPON_TIER + extra


def item_price(own: Column, inherited: Column) -> Column:
    """An item's own price, else the first base price up its type's parents (graph.inherited finds it), else null."""
    return F.coalesce(own, inherited)


def craft_margin(parts: Column, price: Column) -> Column:
    """Sum of price * count over an array of (price, count), against the made item's price."""
    return F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["price"] * p["count"]) / price - 1
