import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.functions.dates import add_months_eom, parse_dates, shift_months, window_start
from foliomart.functions.display import format_report, money_text, percent_text


def one(spark, column):
    return spark.range(0, 1, 1, 1).select(column.alias("x")).first()["x"]


def dec(text):
    return F.lit(text).cast("decimal(20,6)")


@pytest.mark.parametrize("text, want", [("2.345", "2.35"), ("-2.345", "-2.35"), ("99999999999", None)])
def test_fit_rounds_half_up_and_drops_what_is_too_large(spark, text, want):
    got = one(spark, n.fit(dec(text), n.MONEY))
    assert got == (want and Decimal(want))
    assert one(spark, n.overflowed(dec(text), n.MONEY)) is (want is None)


def test_guard_is_positive_not_nonzero(spark):
    assert one(spark, n.guarded(dec("6"), dec("4"))) == Decimal("1.5")
    assert one(spark, n.guarded(dec("6"), dec("0"))) == 0
    assert one(spark, n.guarded(dec("6"), dec("-4"))) == 0
    assert one(spark, n.guarded(F.lit(None).cast("decimal(20,6)"), dec("4"))) is None


def test_deviation_of_one_value_is_zero(frame):
    df = frame("g string, x double", ("a", 1.0), ("b", 1.0), ("b", 3.0))
    got = dict(df.groupBy("g").agg(n.stddev_one_is_zero(F.col("x"))).collect())
    assert got["a"] == 0.0 and got["b"] == pytest.approx(2**0.5)


def test_unknown_condition_holds(spark):
    assert one(spark, n.holds(F.lit(None).cast("boolean"))) is True


def test_dates_by_first_format_that_fits(frame):
    df = frame(
        "s string", ("2024-7-1",), ("01-07-2024",), (" 2024/07/01 ",), ("2024-02-30",), ("",), (None,), ("07.01.2024",)
    )
    got = [(r["date_parsed"], r["date_format"]) for r in parse_dates(df, "s").collect()]
    day = dt.date(2024, 7, 1)
    assert got == [
        (day, "yyyy-MM-dd"), (day, "dd-MM-yyyy"), (day, "yyyy/MM/dd"),
        (None, ""), (None, ""), (None, ""), (None, ""),
    ]


@pytest.mark.parametrize("day, months, want", [
    (dt.date(2023, 2, 28), 1, dt.date(2023, 3, 31)),
    (dt.date(2024, 2, 28), 1, dt.date(2024, 3, 28)),
    (dt.date(2023, 3, 30), -1, dt.date(2023, 2, 28)),
    (dt.date(2024, 1, 31), 1, dt.date(2024, 2, 29)),
    (dt.date(2024, 12, 15), 13, dt.date(2026, 1, 15)),
])
def test_month_ends_stay_month_ends(spark, day, months, want):
    assert one(spark, add_months_eom(F.lit(day), months)) == want
    assert shift_months(day, months) == want


def test_window_start_respects_the_time_of_day():
    assert window_start(dt.datetime(2001, 8, 1)) == dt.date(2000, 8, 1)
    assert window_start(dt.datetime(2001, 8, 1, 9)) == dt.date(2000, 8, 2)


@pytest.mark.parametrize("text, want", [
    ("0.125", "£0.13"), ("-1234567.885", "-£1,234,567.89"), ("-0.001", "£0.00"), ("7", "£7.00"),
])
def test_money(spark, text, want):
    assert one(spark, money_text(dec(text))) == want


def test_percent_of_nothing_is_the_bare_sign(spark):
    assert one(spark, percent_text(F.lit(None).cast("double"))) == "%"
    assert one(spark, percent_text(F.lit(80.565))) == "80.57%"


def test_report_keeps_column_order(frame):
    df = frame("a string, b double, c double", ("x", 1.0, 2.0))
    got = format_report(df, money=["b"], pct=["c"], names={"a": "A b"})
    assert got.columns == ["A b", "b", "c"] and tuple(got.first()) == ("x", "£1.00", "2.00%")
