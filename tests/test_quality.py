import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foliomart.operators import quality as q
from foliomart.sources.staging import stage


def test_findings(frame):
    df = frame("a string, b string, c string", ("1", "-1", "x"), ("", "0", None), ("z", None, "y"), ("9", "3", "x"))
    rules = q.Rules(
        numeric=["a", "missing"], positive=["b"], ranges={"a": (2, 8)}, categories={"c": ["x"]}, dates=["c"]
    )
    got = {r["validation_rule"]: r for r in q.check(df, "s", {"s": rules}, batch_id=4).collect()}
    assert {k: r["invalid_records"] for k, r in got.items()} == {
        "numeric:a": 2,  # empty counts as not numeric
        "positive:b": 1,  # zero passes, missing is not counted
        "range:a": 2,
        "category:c": 2,  # missing counts
        "date:c": 3,
    }
    assert got["category:c"]["error_details"] == "c: 2 values that are none of x"
    assert got["numeric:a"]["error_details"] == "a: 2 cells without a number"
    assert got["range:a"]["error_details"] == "a: 2 values not between 2 and 8"
    assert (got["positive:b"]["valid_records"], got["positive:b"]["batch_id"]) == (3, 4)
    assert q.check(df, "unknown").count() == 0


def test_staging_keeps_digits_and_notes_cells_that_are_no_numbers(frame):
    header = "SaleNum string, DateStamp string, TQty string, UPrice string, PD string, BC string"
    df = frame(header, ("S1", "2024-1-2", " 3 ", "1.5", "1", "1"), ("S2", "x", "three", "1.1234567", "1", "1"))
    made = q.tag(stage(df, "raw_sales", F.lit("f.csv")), "raw_sales").orderBy("sale_num").collect()
    good, bad = made
    assert (good["tqty"], good["validation_status"], good["processed_flag"]) == (3, "VALID", "N")
    assert good["date_parsed"] == dt.date(2024, 1, 2) and good["source_filename"] == "f.csv"
    assert bad["validation_status"] == "INVALID"
    for note in ("tqty", "date not readable"):
        assert note in bad["validation_errors"]
    assert "uprice" not in bad["validation_errors"] and str(bad["uprice"]) == "1.1234567000"
    with pytest.raises(ValueError):
        stage(df, "other")


def test_keys_and_constraints(frame):
    df = frame("k int, x int", (1, 5), (1, None), (2, -1), (None, 1))
    assert [tuple(r) for r in q.duplicates(df, ["k"]).collect()] == [(1, 2)]
    dim = frame("id int", (1,), (3,))
    assert [tuple(r) for r in q.orphans(df, dim, "k", "id").collect()] == [(2, 1)]
    got = {r[0]: r[2] for r in q.violations(df, {"pos": "x > 0", **q.not_null_checks(["k"])}).collect()}
    assert got == {"pos": 1, "nn_k": 1}  # an unknown condition passes


def test_imputation(frame):
    df = frame("chnl string, dscnt decimal(18,6)", ("a", Decimal("0.1")), ("a", Decimal("0.2")), ("a", None), ("b", None))
    assert q.impute_discount(df).filter("discount_imputed IS NOT NULL").count() == 0
    got = q.impute_discount(df, "channel_mean").filter("dscnt IS NULL").collect()
    assert {r["chnl"]: r["discount_imputed"] for r in got} == {"a": Decimal("0.15"), "b": None}
    with pytest.raises(ValueError):
        q.impute_discount(df, "guess")
