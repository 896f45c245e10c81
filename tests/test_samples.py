"""Totals of made-up extracts against the same rules in plain decimals."""

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from foliomart.operators import dimensions as d
from foliomart.operators import quality
from foliomart.operators.calendar import calendar
from foliomart.operators.facts import build_fact_daily, build_fact_sales
from foliomart.operators.lookups import Star
from foliomart.plans import queries as bi
from foliomart.plans import rollups
from foliomart.sources.extract import extract
from foliomart.sources.staging import stage
from samples import META, write_extracts

AS_OF = dt.datetime(2024, 12, 31)
RATE = {"USD": Decimal("0.79"), "EUR": Decimal("0.85"), "GBP": Decimal(1)}
FORMATS = ["%Y-%m-%d", "%d-%m-%Y", "%Y/%m/%d"]


def cents(value, places=2):
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def dates(rnd):
    return dt.date(2023, 1, 1) + dt.timedelta(rnd.randrange(731))


def sales_rows(rnd, n=130):
    rows = []
    for i in range(n):
        rows.append(
            {
                "num": f"T{i:04}", "day": dates(rnd), "ed": rnd.choice(["E1", "E2", "E5"]), "chnl": rnd.choice(["CH001", "CH002", "CH003"]),
                "qty": rnd.randint(50, 200), "price": Decimal(rnd.randint(1000, 4000)) / 100, "curr": rnd.choice(sorted(RATE)),
                "disc": rnd.choice([None, *(Decimal(k) / 100 for k in range(26))]), "pd": rnd.randint(500, 2000),
                "bc": Decimal(rnd.randint(140_000, 740_000)) / 100, "typ": rnd.choice(["Hardcover", "Paperback", "e‑Book"]),
            }
        )
    return rows


def daily_rows(rnd, n=120):
    keys = set()
    while len(keys) < n:
        keys.add((dates(rnd), rnd.choice(["DC001", "DC002"]), rnd.choice(["Hardcover", "Paperback", "e‑Book"])))
    return [
        {
            "day": day, "dc": dc, "typ": typ, "pd": rnd.randint(550, 2000), "bc": Decimal(rnd.randint(150_000, 720_000)) / 100,
            "us": rnd.randint(500, 2000), "rv": rnd.randint(-10, 60), "rev": Decimal(rnd.randint(860_000, 6_200_000)) / 100,
        }
        for day, dc, typ in sorted(keys)
    ]


def sale_measures(r):
    price = cents(r["price"] * RATE[r["curr"]])
    gross = cents(price * r["qty"])
    net = gross - cents(gross * (r["disc"] or 0))
    cost = cents(cents(r["bc"] / r["pd"]) * r["qty"])
    return {"gross": gross, "net": net, "cost": cost, "profit": net - cost, "margin": cents((net - cost) * 100 / net)}


def daily_measures(r):
    unit = cents(r["bc"] / r["pd"], 4)
    cost = cents(unit * r["us"])
    return {
        "unit": unit, "cost": cost, "profit": r["rev"] - cost, "margin": cents((r["rev"] - cost) * 100 / r["rev"]),
        "used": cents(Decimal(r["us"] * 100) / r["pd"]), "back": cents(Decimal(r["rv"] * 100) / r["us"]),
    }


@pytest.fixture(scope="module")
def given():
    rnd = random.Random(2024)
    return sales_rows(rnd), daily_rows(rnd)


@pytest.fixture(scope="module")
def rows(spark, given, tmp_path_factory):
    sales, daily = given
    rnd = random.Random(1)
    lines = [
        f"{r['num']},{r['day'].strftime(rnd.choice(FORMATS))},{r['ed']},{r['chnl']},{r['qty']},{r['price']},{r['curr']},"
        f"{'' if r['disc'] is None else r['disc']},{r['pd']},{r['bc']},5.0,{r['typ']}"
        for r in sales
    ]
    days = [
        f"{r['day'].strftime(rnd.choice(FORMATS))},{r['dc']},{r['pd']},{r['bc']},{r['us']},{r['rv']},{r['rev']},20.0,50,4.5,{r['typ']},"
        for r in daily
    ]
    paths = write_extracts(tmp_path_factory.mktemp("samples"), lines, days, META)
    return {source: extract(spark, path, source)[0] for source, path in paths.items()}


@pytest.fixture(scope="module")
def world(spark, rows):
    staged = {s: quality.tag(stage(r, s), s).checkpoint() for s, r in rows.items()}
    meta, day = staged["raw_meta"], F.lit(dt.date(2023, 1, 1))
    author, vendor = d.dim_author(meta, day).cache(), d.dim_vendor(meta, day).cache()
    tables = {
        "author": author, "vendor": vendor, "dc": d.dim_dc(meta, day),
        "product": d.dim_product(meta, author, vendor, day), "channel": d.dim_channel(spark),
        "product_type": d.dim_product_type(spark), "currency": d.dim_currency(spark),
    }
    named = {k: d.with_unknown(t, f"{k}_key").cache() for k, t in tables.items()}
    star = Star(named, time=calendar(spark).cache(), station_vendor=d.station_vendor(meta))
    sales, refused = build_fact_sales(staged["raw_sales"], star, 1)
    daily, late = build_fact_daily(staged["raw_daily"], star, 1)
    assert refused.count() == 0 and late.count() == 0
    return staged, star, sales.cache(), daily.cache()


def totals(df, *columns):
    return tuple(df.agg(*[F.sum(c) for c in columns]).first())


def summed(rows, measure, *names):
    made = [measure(r) for r in rows]
    return tuple(sum(m[n] for m in made) for n in names)


def test_sales_totals(world, given):
    _, _, sales, _ = world
    assert sales.count() == 130
    assert totals(
        sales, "gross_amount_gbp", "net_amount_gbp", "total_cost_gbp", "gross_profit_gbp", "gross_margin_pct"
    ) == summed(given[0], sale_measures, "gross", "net", "cost", "profit", "margin")


def test_rejecting_unknown_members(world, given):
    staged, star, _, _ = world
    fact, refused = build_fact_sales(staged["raw_sales"], star, 1, unknown="reject")
    known = [r for r in given[0] if r["ed"] != "E5"]
    assert totals(fact, "net_amount_gbp", "gross_profit_gbp") == summed(known, sale_measures, "net", "profit")
    assert [tuple(r) for r in refused.groupBy("reject_reason").count().collect()] == [("UNKNOWN_PRODUCT", 130 - len(known))]


def test_daily_totals(world, given):
    _, star, _, daily = world
    assert totals(daily, "units_sold", "returns_qty") == (sum(r["us"] for r in given[1]), sum(r["rv"] for r in given[1]))
    assert totals(
        daily, "cost_of_goods_sold", "gross_profit_gbp", "gross_margin_pct", "print_run_utilization", "return_rate_pct"
    ) == summed(given[1], daily_measures, "cost", "profit", "margin", "used", "back")
    by_dc = rollups.daily_dc_performance(daily, star).groupBy("station_code").agg(F.sum("total_revenue_gbp"), F.sum("total_profit_gbp"))
    for code, revenue, profit in map(tuple, by_dc.collect()):
        own = [r for r in given[1] if r["dc"] == code]
        assert (revenue, profit) == (sum(r["rev"] for r in own), *summed(own, daily_measures, "profit"))


def test_product_types(world, given):
    _, star, sales, _ = world
    want = defaultdict(list)
    for r in given[0]:
        want[r["typ"].replace("‑", "-"), r["day"].year].append(sale_measures(r))
    got = {(r["product_type_name"], r["year"]): r for r in bi.product_type_profitability(sales, star, AS_OF).collect()}
    assert set(got) == set(want)
    for key, own in want.items():
        assert got[key]["transaction_count"] == len(own) and got[key]["total_revenue"] == sum(m["net"] for m in own)
        assert got[key]["avg_margin_pct"] == pytest.approx(float(sum(m["margin"] for m in own)) / len(own))


def test_channels(world, given):
    _, star, sales, _ = world
    by_code = rollups.channel_performance(sales, star).groupBy("channel_code").agg(F.sum("transaction_count"), F.sum("net_revenue_gbp"))
    for code, n, net in map(tuple, by_code.collect()):
        own = [r for r in given[0] if r["chnl"] == code]
        assert (n, net) == (len(own), *summed(own, sale_measures, "net"))


def test_trend(world, given):
    _, star, sales, _ = world
    want = defaultdict(Decimal)
    for r in given[0]:
        want[r["day"].year, r["day"].month] += sale_measures(r)["net"]
    months = bi.monthly_trend(sales, star, AS_OF).collect()
    revenue = [want[k] for k in sorted(want)]
    assert [r["revenue"] for r in months] == revenue
    growth = [None] + [float((b - a) / a * 100) for a, b in zip(revenue, revenue[1:])]
    assert months[0]["revenue_growth_pct"] is None
    assert [r["revenue_growth_pct"] for r in months[1:]] == pytest.approx(growth[1:])


def test_vendor_spread(world, given):
    _, star, _, daily = world
    for row in rollups.vendor_cost_analysis(daily, star).filter("vendor_id = 'V001'").collect():
        own = [r for r in given[1] if r["dc"] == "DC001" and (r["day"].year, (r["day"].month + 2) // 3) == (row["year"], row["quarter_number"])]
        units = [float(daily_measures(r)["unit"]) for r in own]
        mean = sum(units) / len(units)
        spread = (sum((u - mean) ** 2 for u in units) / (len(units) - 1)) ** 0.5 if len(units) > 1 else 0.0
        assert row["operation_days"] == len(own) and row["avg_unit_cost"] == pytest.approx(mean)
        assert row["cost_stddev"] == pytest.approx(spread, abs=1e-9)


def test_findings(rows, given):
    found = {
        r["validation_rule"]: r["invalid_records"]
        for s in ("raw_sales", "raw_daily")
        for r in quality.issues(quality.check(rows[s], s)).collect()
    }
    assert found["numeric:Dscnt"] == sum(r["disc"] is None for r in given[0])
    assert found["positive:RV"] == sum(r["rv"] < 0 for r in given[1])
