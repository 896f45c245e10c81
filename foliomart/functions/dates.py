"""Date parsing over several formats and month arithmetic that keeps month ends."""

from __future__ import annotations

import calendar as _days
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted formats in order of preference, and the name reported for each.
# Single letters also accept days and months written without a leading zero.
DATE_FORMATS = {
    "yyyy-MM-dd": "yyyy-M-d",
    "dd-MM-yyyy": "d-M-yyyy",
    "yyyy/MM/dd": "yyyy/M/d",
}


def parsed_date(text: Column, formats: dict[str, str] = DATE_FORMATS) -> Column:
    """The date by the first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(p)) for p in formats.values()]).cast("date")


def matched_format(text: Column, formats: dict[str, str] = DATE_FORMATS) -> Column:
    """The name of the first format that fits; empty where the text is missing or fits none."""
    names = [
        F.when(F.try_to_timestamp(F.trim(text), F.lit(pattern)).isNotNull(), F.lit(name))
        for name, pattern in formats.items()
    ]
    return F.coalesce(*names, F.lit(""))


def parse_dates(df: DataFrame, column: str, formats: dict[str, str] = DATE_FORMATS) -> DataFrame:
    """Add ``date_parsed`` and ``date_format``."""
    return df.withColumns(
        {
            "date_parsed": parsed_date(F.col(column), formats),
            "date_format": matched_format(F.col(column), formats),
        }
    )


def time_key(day: Column) -> Column:
    """The calendar key YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def add_months_eom(day: Column, months: int) -> Column:
    """Month arithmetic in which the last day of a month stays the last day."""
    moved = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def as_timestamp(as_of: dt.date | dt.datetime) -> dt.datetime:
    if isinstance(as_of, dt.datetime):
        return as_of
    return dt.datetime.combine(as_of, dt.time())


def shift_months(day: dt.date, months: int) -> dt.date:
    """The same rule as ``add_months_eom`` for a driver-side date."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    last = _days.monthrange(year, month)[1]
    at_end = day.day == _days.monthrange(day.year, day.month)[1]
    return dt.date(year, month, last if at_end else min(day.day, last))


def window_start(as_of: dt.date | dt.datetime, months: int = 12) -> dt.date:
    """First calendar day at or after ``as_of`` moved back by ``months``.

    A time of day after midnight puts that day itself before the moved instant.
    """
    moment = as_timestamp(as_of)
    first = shift_months(moment.date(), -months)
    return first if moment.time() == dt.time() else first + dt.timedelta(days=1)
