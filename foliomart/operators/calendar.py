"""The calendar dimension: one row per day with UK fiscal and holiday attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomart.functions.dates import time_key

# Default span and holiday names.
FIRST_DAY = dt.date(2018, 1, 1)
LAST_DAY = dt.date(2026, 12, 31)
NEW_YEAR = "New Year's Day"
EARLY_MAY = "Early May Bank Holiday"
SPRING = "Spring Bank Holiday"
SUMMER = "Summer Bank Holiday"
CHRISTMAS = "Christmas Day"
BOXING = "Boxing Day"
GOOD_FRIDAY = "Good Friday"
EASTER_MONDAY = "Easter Monday"

SEASONS = {"Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}


def _flag(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def easter_sunday(year: Column) -> Column:
    """Western Easter of a year by the anonymous Gregorian computus (a public formula)."""

    def whole(x: Column) -> Column:
        return F.floor(x).cast("int")

    golden = year % 19
    century = whole(year / 100)
    in_century = year % 100
    epact = (19 * golden + century - whole(century / 4)
             - whole((century - whole((century + 8) / 25) + 1) / 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * whole(in_century / 4) - epact - in_century % 4) % 7
    late = whole((golden + 11 * epact + 22 * weekday) / 451)
    march_day = epact + weekday - 7 * late + 114
    return F.make_date(year, whole(march_day / 31), march_day % 31 + 1)


def holiday_name(day: Column, easter: bool = False) -> Column:
    """Name of the UK holiday on a day, null on ordinary days."""
    month, number = F.month(day), F.dayofmonth(day)
    monday = F.weekday(day) == 0
    in_last_week = number >= 25  # May and August both have 31 days
    name = (
        F.when((month == 1) & (number == 1), NEW_YEAR)
        .when((month == 12) & (number == 25), CHRISTMAS)
        .when((month == 12) & (number == 26), BOXING)
        .when(monday & (month == 5) & (number <= 7), EARLY_MAY)
        .when(monday & (month == 5) & in_last_week, SPRING)
        .when(monday & (month == 8) & in_last_week, SUMMER)
    )
    if easter:
        sunday = easter_sunday(F.year(day))
        name = name.when(day == F.date_sub(sunday, 2), GOOD_FRIDAY).when(
            day == F.date_add(sunday, 1), EASTER_MONDAY
        )
    return name


def with_attributes(days: DataFrame, easter: bool = False) -> DataFrame:
    """The 31 calendar columns for a frame of distinct ``full_date`` values."""
    day = F.col("full_date")
    month, number, year = F.month(day), F.dayofmonth(day), F.year(day)
    quarter_name = F.concat(F.lit("Q"), F.quarter(day))
    month_abbr = F.date_format(day, "MMM")
    fiscal_month = F.when(month >= 4, month - 3).otherwise(month + 9)
    week_start = F.date_sub(day, F.weekday(day))
    holiday = holiday_name(day, easter)
    at_month_end = day == F.last_day(day)
    season = F.lit("Winter")
    for label, months in SEASONS.items():
        season = F.when(month.isin(*months), label).otherwise(season)
    columns = {
        "time_key": time_key(day),
        "full_date": day,
        "day_of_week": F.weekday(day) + 1,
        "day_of_week_name": F.date_format(day, "EEEE"),
        "day_of_month": number,
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month_number": month,
        "month_name": F.date_format(day, "MMMM"),
        "month_abbr": month_abbr,
        "quarter_number": F.quarter(day),
        "quarter_name": quarter_name,
        "year": year,
        "fiscal_year": F.when(month >= 4, year + 1).otherwise(year),
        "fiscal_quarter": F.ceil(fiscal_month / 3).cast("int"),
        "fiscal_month": fiscal_month,
        "is_weekend": _flag(F.weekday(day) >= 5),
        "is_uk_holiday": _flag(holiday.isNotNull()),
        "uk_holiday_name": holiday,
        "is_month_start": _flag(number == 1),
        "is_month_end": _flag(at_month_end),
        "is_quarter_start": _flag((number == 1) & (month % 3 == 1)),
        "is_quarter_end": _flag(at_month_end & (month % 3 == 0)),
        "is_year_start": _flag((number == 1) & (month == 1)),
        "is_year_end": _flag(at_month_end & (month == 12)),
        "week_start_date": week_start,
        "week_end_date": F.date_add(week_start, 6),
        "month_year_name": F.concat_ws(" ", month_abbr, year.cast("string")),
        "quarter_year_name": F.concat_ws(" ", quarter_name, year.cast("string")),
        "days_in_month": F.dayofmonth(F.last_day(day)),
        "season": season,
    }
    return days.select(*[value.alias(name) for name, value in columns.items()])


def calendar(
    spark: SparkSession,
    start: dt.date = FIRST_DAY,
    end: dt.date = LAST_DAY,
    easter: bool = False,
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    span = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date")
    return with_attributes(spark.range(0, 1, 1, 1).select(span), easter)


def calendar_spanning(df: DataFrame, column: str, easter: bool = False) -> DataFrame:
    """The calendar from the first to the last date found in a column."""
    ends = df.agg(
        F.min(F.col(column)).cast("date").alias("lo"), F.max(F.col(column)).cast("date").alias("hi")
    )
    return with_attributes(ends.select(F.explode(F.sequence("lo", "hi")).alias("full_date")), easter)


def calendar_report(cal: DataFrame) -> DataFrame:
    """Five check figures as (metric, value) rows; values are text because they mix types."""
    one = cal.agg(
        F.count(F.lit(1)).alias("days"),
        F.min("full_date").alias("lo"),
        F.max("full_date").alias("hi"),
        F.count_if(F.col("is_weekend") == "Y").alias("weekends"),
        F.count_if(F.col("is_uk_holiday") == "Y").alias("holidays"),
        F.count_distinct("fiscal_year").alias("fiscal_years"),
    )
    metrics = {
        "Total Records": F.col("days").cast("string"),
        "Date Range": F.concat_ws(" to ", F.col("lo").cast("string"), F.col("hi").cast("string")),
        "Weekends": F.col("weekends").cast("string"),
        "UK Holidays": F.col("holidays").cast("string"),
        "Fiscal Years": F.col("fiscal_years").cast("string"),
    }
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics.items()])
    return one.select(F.inline(rows))
