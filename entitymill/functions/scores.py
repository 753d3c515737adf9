"""Integer rounding helpers and score tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import LOWEST_TIER, TIER_FLOORS


def tier_of(score: Column, scale: int = 1) -> Column:
    """PLATINUM / GOLD / SILVER / BRONZE; scale is 100 for scores in integer hundredths."""
    result = None
    for name, floor in TIER_FLOORS:
        test = score >= floor * scale
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise(LOWEST_TIER)


def div_half_up(numerator: Column, denominator: Column) -> Column:
    """Integer quotient of non-negative integers, half rounded up; NULL when dividing by 0."""
    whole = F.nullif(denominator.cast("long"), F.lit(0).cast("long"))
    return F.call_function("div", numerator.cast("long") * 2 + whole, whole * 2)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole rounded half up to the given digits, free of float drift."""
    scale = 10**digits
    return div_half_up(part.cast("long") * (100 * scale), whole) / F.lit(float(scale))
