"""Scalar and aggregate column expressions. All stay inside Catalyst code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest rating of each tier, best first; anything else is the last tier.
DRIVER_TIERS = (("Gold", "4.8"), ("Silver", "4.3"))
LOWEST_TIER = "Bronze"


def text_enum(column: Column | str) -> Column:
    """Enum text in the one case that every comparison uses."""
    return F.lower(column)


def surge_multiplier(base_fare: Column, surge_fare: Column) -> Column:
    """Surge over base to two decimals; 1.0 where there is no positive base fare."""
    ratio = F.round(surge_fare / base_fare, 2)
    return F.when(base_fare > 0, ratio).otherwise(F.lit("1.00").cast("decimal(13,2)"))


def is_cancelled(status: Column) -> Column:
    """1 for a cancelled trip, 0 for any other status and for none."""
    return F.coalesce((text_enum(status) == "cancelled").cast("int"), F.lit(0))


def driver_tier(rating: Column) -> Column:
    """Tier by rating. An unrated driver falls through to the lowest tier."""
    tier = F.lit(LOWEST_TIER)
    for name, least in reversed(DRIVER_TIERS):
        tier = F.when(rating >= F.lit(least).cast("decimal(3,2)"), name).otherwise(tier)
    return tier


def exact_mean(value: Column, digits: int = 2) -> Column:
    """Mean of a decimal column, rounded half up in decimal arithmetic; NULL for no values."""
    return F.round(F.sum(value) / F.nullif(F.count(value), F.lit(0)), digits)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """`part` of `whole` as a fraction; NULL for an empty whole."""
    return F.round(part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)), digits)


def moment(at: datetime | str) -> Column:
    """A zone-free timestamp literal, folded at planning time so that it can be pushed down."""
    text = at if isinstance(at, str) else at.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")
