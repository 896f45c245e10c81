"""Exact decimal arithmetic: rounding per step, overflow as a finding, guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
UNIT_COST = "decimal(12,4)"
RATE = "decimal(12,6)"
QUANTITY = "decimal(10,2)"
DISCOUNT = "decimal(5,4)"
PERCENT = "decimal(5,2)"
SCORE = "decimal(3,1)"
TEMPERATURE = "decimal(4,1)"
# Staged numbers keep the source's digits; they round when they are assigned to a measure.
STAGED = "decimal(38,10)"
# What arithmetic starts from: every digit a measure of up to ten whole digits can use, and narrow
# enough that products and quotients stay exact.
OPERAND = "decimal(20,10)"


def fit(value: Column, dtype: str) -> Column:
    """Round half up into ``dtype``; a value too large becomes null instead of failing the job."""
    return value.try_cast(dtype)


def overflowed(value: Column, dtype: str) -> Column:
    """True where ``fit`` had to drop a value."""
    return value.isNotNull() & fit(value, dtype).isNull()


def guarded(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else zero."""
    return F.when(
        denominator > 0, numerator / F.when(denominator > 0, denominator)
    ).otherwise(F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """One double division of two exact values; null where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    """Average from an exact sum and a count, so partial sums in any order agree."""
    return ratio(F.sum(value), F.count(value))


def stddev_one_is_zero(value: Column) -> Column:
    """Sample deviation that is zero, not null, for a single value."""
    return F.when(F.count(value) == 1, F.lit(0.0)).otherwise(F.stddev_samp(value))


def holds(condition: Column) -> Column:
    """A constraint passes when its condition is unknown."""
    return F.coalesce(condition, F.lit(True))


def growth_pct(now: Column, before: Column) -> Column:
    """Change against the previous period in percent."""
    return ratio(now - before, before) * 100
