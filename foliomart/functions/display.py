"""Money and percent texts for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_text(value: Column, symbol: str = "£") -> Column:
    """``£1,234.50``; rounded half up, because ``format_number`` alone rounds half to even."""
    exact = value.cast("decimal(38,10)")
    rounded = F.round(F.abs(exact), 2)
    sign = F.when((exact < 0) & (rounded > 0), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit(symbol), F.format_number(rounded, 2))


def number_text(value: Column) -> Column:
    """Two decimals without grouping."""
    return F.round(value.cast("decimal(38,10)"), 2).cast("decimal(28,2)").cast("string")


def percent_text(value: Column) -> Column:
    """``81.50%``; a missing value leaves the bare sign, as concatenation with an empty text does."""
    return F.concat(F.coalesce(number_text(value), F.lit("")), F.lit("%"))


def format_report(
    df: DataFrame,
    money: list[str] = (),
    pct: list[str] = (),
    plain: list[str] = (),
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Replace typed columns by their display texts and rename them for reading."""
    shown = {name: money_text(F.col(name)) for name in money}
    shown |= {name: percent_text(F.col(name)) for name in pct}
    shown |= {name: number_text(F.col(name)) for name in plain}
    labels = names or {}
    return df.select(
        *[shown.get(name, F.col(name)).alias(labels.get(name, name)) for name in df.columns]
    )
