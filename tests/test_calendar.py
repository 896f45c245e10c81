import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliomart.operators import calendar as c
from foliomart.operators.quality import TIME_CHECKS, violations


@pytest.fixture(scope="module")
def cal(spark):
    return c.calendar(spark).cache()


def test_report(cal):
    assert dict(c.calendar_report(cal).collect()) == {
        "Total Records": "3287",
        "Date Range": "2018-01-01 to 2026-12-31",
        "Weekends": "938",
        "UK Holidays": "54",
        "Fiscal Years": "10",
    }


def test_a_day(cal):
    row = cal.filter("time_key = 20240527").first()
    assert len(cal.columns) == 31
    want = {
        "full_date": dt.date(2024, 5, 27), "day_of_week": 1, "day_of_week_name": "Monday", "day_of_year": 148,
        "week_of_year": 22, "month_name": "May", "month_abbr": "May", "quarter_name": "Q2", "fiscal_year": 2025,
        "fiscal_quarter": 1, "fiscal_month": 2, "is_weekend": "N", "is_uk_holiday": "Y",
        "uk_holiday_name": "Spring Bank Holiday", "week_start_date": dt.date(2024, 5, 27),
        "week_end_date": dt.date(2024, 6, 2), "month_year_name": "May 2024", "quarter_year_name": "Q2 2024",
        "days_in_month": 31, "season": "Spring",
    }
    assert {k: row[k] for k in want} == want


def test_edges(cal):
    flags = {r["time_key"]: r for r in cal.collect()}
    assert flags[20240331]["is_quarter_end"] == "Y" and flags[20240331]["fiscal_month"] == 12
    assert flags[20240229]["is_month_end"] == "Y" and flags[20240228]["is_month_end"] == "N"
    assert flags[20241231]["is_year_end"] == "Y" and flags[20241230]["week_of_year"] == 1
    assert flags[20180101]["is_year_start"] == "Y" and flags[20180101]["season"] == "Winter"
    assert all(r["invalid_records"] == 0 for r in violations(cal, TIME_CHECKS).collect())


def test_easter(spark):
    # published dates of Western Easter Sunday
    known = {1818: "1818-03-22", 1943: "1943-04-25", 2000: "2000-04-23", 2024: "2024-03-31", 2038: "2038-04-25"}
    rows = spark.createDataFrame([(y,) for y in known], "year int")
    got = rows.select("year", c.easter_sunday(F.col("year")).cast("string")).collect()
    assert dict(got) == known
    named = c.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31), easter=True)
    days = dict(named.filter("is_uk_holiday = 'Y'").select("uk_holiday_name", "time_key").collect())
    assert days["Good Friday"] == 20240329 and days["Easter Monday"] == 20240401 and len(days) == 8


def test_span_comes_from_the_data(frame):
    df = frame("d date", (dt.date(2024, 2, 27),), (dt.date(2024, 3, 1),), (None,))
    assert c.calendar_spanning(df, "d").count() == 4
