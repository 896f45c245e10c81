import datetime as dt
import math
import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foliomart.operators.calendar import calendar
from foliomart.operators.lookups import Star, view
from foliomart.plans import queries as bi
from foliomart.plans import rollups, trends
from foliomart.sources.warehouse import rewrite_months, write_fact

AS_OF = dt.datetime(2024, 6, 30, 12)
FACT = (
    "sales_fact_key bigint, time_key int, product_key bigint, author_key bigint, dc_key bigint, channel_key bigint,"
    " product_type_key bigint, sale_number string, quantity_sold decimal(10,2), discount_rate decimal(5,4),"
    " discount_amount_gbp decimal(12,2), gross_amount_gbp decimal(12,2), net_amount_gbp decimal(12,2),"
    " total_cost_gbp decimal(12,2), gross_profit_gbp decimal(12,2), gross_margin_pct decimal(5,2)"
)
DAILY = (
    "time_key int, vendor_key bigint, print_run_qty bigint, binding_cost_gbp decimal(12,2),"
    " unit_binding_cost decimal(12,4), vendor_score decimal(3,1)"
)


@pytest.fixture(scope="module")
def star(spark):
    made = spark.createDataFrame
    product = [(1, "E1", "One", "Y"), (2, "E2", "Two", "N"), (3, "E2", "Two b", "Y"), (4, "E4", "Four", "Y")]
    return Star(
        time=calendar(spark, dt.date(2021, 1, 1), dt.date(2024, 12, 31)).cache(),
        product=made(product, "product_key bigint, edition_id string, product_title string, is_current string"),
        author=made([(1, "A1", "Ann", "Poetry", "Y")], "author_key bigint, author_id string, full_name string, primary_genre string, is_current string"),
        dc=made([(i, f"DC{i}", f"C{i}", "N" if i < 3 else None, "Y") for i in (1, 2, 3, 4)],
                "dc_key bigint, station_code string, station_name string, station_region string, is_current string"),
        channel=made([(1, "CH1", "Shop", "Physical"), (2, "CH2", "Web", "Online")],
                     "channel_key bigint, channel_code string, channel_name string, channel_type string"),
        product_type=made([(1, "Hardcover", "Y"), (2, "e-Book", "N")],
                          "product_type_key bigint, product_type_name string, is_physical string"),
        vendor=made([(1, "V1", "Old", "N"), (2, "V1", "New", "Y"), (3, "V3", "Lone", "Y")],
                    "vendor_key bigint, vendor_id string, vendor_name string, is_current string"),
    )


@pytest.fixture(scope="module")
def facts():
    rng = random.Random(5)
    rows = []
    for i in range(800):
        day = dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(1277))
        gross, discount, cost = (Decimal(rng.randrange(1, 99999)) / 100 for _ in range(3))
        net = gross - discount
        margin = None if i % 40 == 0 else Decimal(rng.randrange(-5000, 9999)) / 100
        rate = None if i % 3 == 0 else Decimal(rng.randrange(2500)) / 10000
        rows.append((
            i, int(day.strftime("%Y%m%d")), rng.choice([1, 2, 3, 4]), 1, 3 if i % 3 == 0 else rng.choice([1, 2, 3, 4]),
            rng.choice([1, 2]), rng.choice([1, 2]), f"S{i}", Decimal(rng.randrange(1, 200)), rate, discount, gross, net,
            cost, net - cost, margin,
        ))
    return rows


@pytest.fixture(scope="module")
def fact(spark, facts):
    return spark.createDataFrame(facts, FACT).cache()


def groups(rows, key):
    out = defaultdict(list)
    for r in rows:
        if key(r) is not None:
            out[key(r)].append(r)
    return out


def avg(values):
    kept = [v for v in values if v is not None]
    return float(sum(kept)) / len(kept) if kept else None


def test_monthly_summary_drops_expired_versions(facts, fact, star):
    made = rollups.monthly_sales_summary(fact, star).collect()
    want = groups(facts, lambda r: None if r[2] == 2 else (r[1] // 10000, r[1] // 100 % 100, r[2], r[5], r[6]))
    names = {1: "E1", 3: "E2", 4: "E4"}
    assert len(made) == len(want)
    by = {(r["year"], r["month_number"], r["edition_id"], r["channel_name"], r["product_type_name"]): r for r in made}
    for (y, m, p, c, k), rows in want.items():
        got = by[y, m, names[p], ["", "Shop", "Web"][c], ["", "Hardcover", "e-Book"][k]]
        assert got["transaction_count"] == len(rows) and got["total_revenue_gbp"] == sum(r[12] for r in rows)
        assert got["avg_margin_pct"] == avg([r[15] for r in rows])
        assert got["avg_discount_rate"] == avg([r[9] for r in rows])
    latest = rollups.monthly_sales_summary(fact, star, "latest")
    assert latest.agg({"transaction_count": "sum"}).first()[0] == len(facts)
    assert {r["product_title"] for r in latest.filter("edition_id = 'E2'").collect()} == {"Two b"}


def test_view_rejects_unknown_versions(star):
    with pytest.raises(ValueError):
        view(star["product"], "product_key", "edition_id", "newest")


def test_vendor_spread_merges_versions(spark, star):
    rng = random.Random(9)
    rows = [(20240100 + rng.randrange(1, 29), rng.choice([1, 2]), 10, Decimal(5), Decimal(rng.randrange(1, 99999)) / 10000, Decimal(7))
            for _ in range(60)] + [(20240501, 3, 10, Decimal(5), Decimal("1.5"), None)]
    fact = spark.createDataFrame(rows, DAILY)
    got = {r["vendor_id"]: r for r in rollups.vendor_cost_analysis(fact, star, "latest").collect()}
    costs = [float(r[4]) for r in rows[:60]]
    assert got["V1"]["vendor_name"] == "New" and got["V1"]["operation_days"] == 60
    assert math.isclose(got["V1"]["cost_stddev"], statistics.stdev(costs), rel_tol=1e-12)
    assert math.isclose(got["V1"]["cost_variance_pct"], statistics.stdev(costs) / statistics.mean(costs) * 100, rel_tol=1e-9)
    assert (got["V3"]["cost_stddev"], got["V3"]["avg_vendor_score"]) == (0.0, None)
    recorded = {r["vendor_id"]: r["operation_days"] for r in rollups.vendor_cost_analysis(fact, star).collect()}
    assert recorded == {"V1": sum(r[1] == 2 for r in rows), "V3": 1}


def test_top_editions(facts, fact, star):
    made = [tuple(r) for r in bi.top_editions_by_region(fact, star, AS_OF, k=2).collect()]
    # a time of day past noon moves the window to the next day
    inside = [r for r in facts if 20230701 <= r[1] and r[2] != 2]
    names = {1: ("E1", "One"), 3: ("E2", "Two b"), 4: ("E4", "Four")}
    regions = groups(inside, lambda r: ("N" if r[4] < 3 else None, r[2]))
    want = []
    for region in ("N", None):  # a missing region sorts last
        ranked = sorted(
            ((avg([r[15] for r in rows]), names[p], rows) for (g, p), rows in regions.items() if g == region),
            key=lambda x: (x[0] is not None, -(x[0] or 0), x[1]),
        )
        for place, (margin, (edition, title), rows) in enumerate(ranked[:2], 1):
            want.append((
                region, edition, title, sum(r[12] for r in rows), sum(r[13] for r in rows), sum(r[14] for r in rows),
                margin, len({r[1] for r in rows}), place,
            ))
    assert made == want


def test_trend_starts_without_a_previous_month(facts, fact, star):
    made = bi.monthly_trend(fact, star, AS_OF).collect()
    months = groups([r for r in facts if r[1] >= 20230101], lambda r: r[1] // 100)
    nets = [sum(r[12] for r in months[m]) for m in sorted(months)]
    assert [r["revenue"] for r in made] == nets and made[0]["month"] == "2023 January"
    assert made[0]["revenue_growth_pct"] is None and made[0]["trend"] == "→"
    for before, now, row in zip(nets, nets[1:], made[1:]):
        assert math.isclose(row["revenue_growth_pct"], float(now - before) / float(before) * 100, rel_tol=1e-12)
        assert row["trend"] == ("↑" if now > before else "↓" if now < before else "→")


def test_ranks_leave_gaps(spark, star):
    rows = [(i, 20240601, 1, 1, dc, 1, 1, f"S{i}", Decimal(1), None, Decimal(0), Decimal(9), Decimal(9), Decimal(1), Decimal(p), None)
            for i, (dc, p) in enumerate([(1, 5), (2, 9), (3, 9), (4, 1)])]
    made = bi.dc_ranking(spark.createDataFrame(rows, FACT), star, AS_OF).collect()
    assert [(r["station_code"], r["profit_rank"]) for r in made] == [("DC2", 1), ("DC3", 1), ("DC1", 3), ("DC4", 4)]


def test_other_questions_keep_the_totals(facts, fact, star):
    roi = bi.author_roi(fact, star, AS_OF).first()
    inside = [r for r in facts if r[1] >= 20230701 and r[2] != 2]
    assert (roi["number_of_editions"], roi["total_profit"]) == (3, sum(r[14] for r in inside))
    assert roi["revenue_per_edition"] == float(sum(r[12] for r in inside)) / 3
    channels = bi.channel_efficiency(fact, star, AS_OF)
    assert [r["period"] for r in channels.collect()][:2] == ["2024 Q1", "2024 Q1"]
    assert channels.agg({"net_revenue": "sum"}).first()[0] == sum(r[12] for r in facts if r[1] >= 20230101)
    kinds = bi.product_type_profitability(fact, star, AS_OF)
    assert kinds.agg({"total_units": "sum"}).first()[0] == sum(r[8] for r in facts if r[1] >= 20220101)


def test_reports_have_display_names(fact, star):
    shown = bi.report("top_editions_by_region", bi.top_editions_by_region(fact, star, AS_OF))
    assert shown.columns == ["Region", "Edition ID", "Product Title", "Total Revenue", "Total Cost", "Gross Profit", "Avg Margin %", "Days Sold"]
    for name in bi.REPORTS:
        assert bi.report(name, getattr(bi, name)(fact, star, AS_OF)).count() > 0


def test_statistics(spark, fact, star, facts):
    corr = trends.correlations(fact, "channel_key", [("quantity_sold", "net_amount_gbp")]).collect()
    rows = [r for r in facts if r[5] == 1]
    want = statistics.correlation([float(r[8]) for r in rows], [float(r[12]) for r in rows])
    assert math.isclose({r[0]: r["correlation"] for r in corr}[1], want, rel_tol=1e-9)
    far = trends.outliers(fact, "channel_key", "net_amount_gbp", limit=1.5)
    nets = [float(r[12]) for r in rows]
    mean, dev = statistics.mean(nets), statistics.stdev(nets)
    assert far.filter("channel_key = 1").count() == sum(abs(x - mean) / dev > 1.5 for x in nets)
    assert trends.outliers(fact, "channel_key", "net_amount_gbp", "iqr", 0.1).count() > 0
    forecast = trends.trend_forecast(fact, star).collect()
    assert {(r["next_year"], r["next_quarter"]) for r in forecast} == {(2024, 3)}
    low = trends.dc_percentile(fact, star, AS_OF).filter("consolidation_candidate").collect()
    assert [r["profit_rank"] for r in low] == [4]
    features = spark.createDataFrame([(f"a{i}", float(i % 2 * 100 + i)) for i in range(10)], "id string, x double")
    parts = trends.segments(features, k=2).groupBy("segment").count().collect()
    assert sorted(r["count"] for r in parts) == [5, 5]
    assert trends.author_features(fact, star).count() == 1


@pytest.mark.parametrize("few", [1, 40, 100_000])
def test_quantiles_by_ranges(spark, monkeypatch, few):
    monkeypatch.setattr(trends, "FEW_ROWS", few)
    monkeypatch.setattr(trends, "PARTS", 8)
    rng = random.Random(5)
    groups = {
        "hot": [rng.lognormvariate(0, 9) for _ in range(3000)], "ties": [7.0] * 500 + [8.0], "one": [-3.5],
        "far": [-1.7e308, 1.7e308, 0.0, 5e-324, 1.0], "digits": [rng.randrange(300) / 100 for _ in range(900)],
    }
    odd = [("hot", None), ("hot", float("nan")), ("hot", float("inf")), (None, 1.0), ("none", None)]
    rows = [(g, x) for g, xs in groups.items() for x in xs] + odd
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = trends.quantiles(spark.createDataFrame(rows, "g string, x double"), "g", "x", shares).collect()
    want = {(g, s): sorted(xs)[max(1, math.ceil(len(xs) * s)) - 1] for g, xs in groups.items() for s in shares}
    assert {(r["g"], r["share"]): r["value"] for r in found} == want and len(found) == len(want)


def test_segments_follow_the_rounds_written_out(spark):
    rng = random.Random(9)
    rows = [(f"a{i:03}", *[rng.gauss(5 * (i % 3), 1.0) for _ in range(2)]) for i in range(120)]
    rows += [("b", None, 4.0), ("c", *rows[0][1:])]

    def grid(column):
        known = [x for x in column if x is not None]
        mean, dev = statistics.mean(known), statistics.stdev(known)
        return [0 if x is None else round((x - mean) / dev * 1_000_000) for x in column]

    points = list(zip(*[grid([r[j] for r in rows]) for j in (1, 2)]))

    def apart(p, c):
        return sum((a - b) ** 2 for a, b in zip(p, c))

    centres = []
    for _ in range(4):
        far = [min((apart(p, c) for c in centres or [(0, 0)])) for p in points]
        centres.append(points[min(range(len(rows)), key=lambda i: (-far[i], rows[i][0]))])
    for _ in range(20):
        near = [min(range(4), key=lambda j: (apart(p, centres[j]), j)) for p in points]
        held = [[p for p, n in zip(points, near) if n == j] for j in range(4)]
        centres = [tuple(sum(v) / len(h) for v in zip(*h)) if h else c for h, c in zip(held, centres)]
    near = [min(range(4), key=lambda j: (apart(p, centres[j]), j)) for p in points]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    want = {r[0]: n for r, n in zip(rows, near)}
    for parts in (1, 7):
        assert {r["id"]: r["segment"] for r in trends.segments(df.repartition(parts)).collect()} == want
    assert trends.segments(df.limit(0)).collect() == []
    same = trends.segments(df.select("id", F.lit(1.0).alias("x"))).select("segment").distinct().collect()
    assert [r[0] for r in same] == [0]


def test_plans(spark, fact, star, tmp_path):
    """Stored facts are pruned by month, joins on fact rows only broadcast the calendar."""
    path = str(tmp_path / "fact")
    write_fact(fact, path)
    stored = spark.read.parquet(path)
    plan = bi.author_roi(stored, star, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "(year_month#" in plan
    assert "GreaterThanOrEqual(time_key,20230701)" in plan
    for name in bi.REPORTS:
        text = getattr(bi, name)(stored, star, AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    top = bi.top_editions_by_region(stored, star, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top
    before = stored.count()
    month = stored.filter("year_month = 202401").drop("year_month").limit(3).checkpoint()
    dropped = stored.filter("year_month = 202401").count() - 3
    rewrite_months(month, path)
    assert spark.read.parquet(path).count() == before - dropped


def test_states_of_batches_add_up(spark, fact, star, tmp_path, monkeypatch):
    """Portions, also added up ones, show what the whole fact does; a changed dimension is seen without it."""
    from pyspark.sql import functions as F

    from foliomart.sources.warehouse import Warehouse

    monkeypatch.setattr(rollups, "PORTIONS", 2)
    w = Warehouse(spark, str(tmp_path))
    batch = F.pmod("sales_fact_key", F.lit(4)) + 1

    def same(a, b):
        return sorted(map(repr, (tuple(r) for r in a.collect()))) == sorted(map(repr, (tuple(r) for r in b.collect())))

    states = rollups.RollupStates(w, "channel_performance")
    for number in (1, 2, 3):
        states.add(number, fact.filter(batch == number), star)
    states.add(3, fact.filter(batch == 3), star)  # a repeat
    states.compact([1, 2, 3])
    states.add(4, fact.filter(batch == 4), star)
    assert states._upto() == 3 and (tmp_path / "state/channel_performance/upto=3").exists()
    assert not (tmp_path / "state/channel_performance/batch=1").exists()
    made = rollups.refresh_from_states(w, "channel_performance", states.read([1, 2, 3, 4]), star)
    assert same(made, rollups.channel_performance(fact, star))
    named = Star({**star, "channel": star["channel"].withColumn("channel_name", F.lit("Renamed"))})
    shown = rollups.refresh_from_states(w, "channel_performance", states.read([1, 2, 3, 4]), named)
    assert same(shown, rollups.channel_performance(fact, named))


def test_vendor_states_keep_the_spread(spark, star, tmp_path):
    from foliomart.sources.warehouse import Warehouse

    rng = random.Random(9)
    rows = [(20240100 + rng.randrange(1, 29), rng.choice([1, 2]), 10, Decimal(5), Decimal(rng.randrange(1, 99999)) / 10000, Decimal(7))
            for _ in range(60)] + [(20240501, 3, 10, Decimal(5), Decimal("1.5"), None)]
    states = rollups.RollupStates(Warehouse(spark, str(tmp_path)), "vendor_cost_analysis")
    for number, part in enumerate((rows[:30], rows[30:]), 1):
        states.add(number, spark.createDataFrame(part, DAILY), star)
    got = {r["vendor_id"]: r for r in states.show(states.read([1, 2]), star, "latest").collect()}
    costs = [float(r[4]) for r in rows[:60]]
    assert math.isclose(got["V1"]["cost_stddev"], statistics.stdev(costs), rel_tol=1e-9)
    assert (got["V3"]["cost_stddev"], got["V3"]["avg_vendor_score"]) == (0.0, None)


@pytest.mark.parametrize("method", ["zscore", "iqr"])
def test_outliers_do_not_shuffle_the_fact(spark, tmp_path, method):
    made = spark.range(20_000).selectExpr("id", "cast(id % 3 as int) AS kind", "cast(id * id % 9973 as double) AS x", "sha2(cast(id AS string), 256) AS text")
    made.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
    try:
        plan = trends.outliers(fact, "kind", "x", method, 0.1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_fact_by_day_is_written_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(0, 90, 1, 3).selectExpr("cast(20240101 + 100 * (id div 45) + id % 28 as int) AS time_key", "90 - id AS product_key")
    write_fact(rows, path, by_day=True)
    read = spark.read.parquet(path)
    assert sorted(map(tuple, read.select("time_key", "product_key").collect())) == sorted(map(tuple, rows.collect()))
    # three parts over two months; a shuffle brings the few rows of a month into one file
    files = {(r["year_month"], r["f"]) for r in read.select("year_month", F.input_file_name().alias("f")).distinct().collect()}
    assert sorted(m for m, _ in files) == [202401, 202401, 202402, 202402]


@pytest.mark.parametrize("version", ["as_recorded", "latest"])
def test_editions_under_several_keys_are_one_row_a_month(spark, version):
    """Rows of an edition under one key stay where the join left them; editions of several keys are added up."""
    month = "year int, month_number int, month_name string, product_key long, channel_key long, product_type_key long"
    sums = ["quantity_sold", "net_amount_gbp", "total_cost_gbp", "gross_profit_gbp", "gross_margin_pct", "discount_rate"]
    schema = f"{month}, _n long, " + ", ".join(f"_s_{c} decimal(22,2)" for c in sums) + ", _c_gross_margin_pct long, _c_discount_rate long"
    rows = [(2024, m, f"M{m}", k, 1 + k % 2, 1, 2, *[Decimal(10 * k + m)] * 6, 2, 2) for m in (1, 2) for k in range(1, 7)]
    states = spark.createDataFrame(rows, schema)
    shared = [(1, "A", "a", "Y"), (2, "A", "a", "Y"), (3, "B", "b", "Y"), (4, None, None, "Y"), (5, None, None, "Y"), (6, "C", "c", "Y")]
    single = [(k, f"E{k}", f"t{k}", "Y") for k in range(1, 7)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for names in (shared, single):
        dims = {
            "product": spark.createDataFrame(names, "product_key long, edition_id string, product_title string, is_current string"),
            "channel": spark.createDataFrame([(1, "one"), (2, "one")], "channel_key long, channel_name string"),
            "product_type": spark.createDataFrame([(1, "x")], "product_type_key long, product_type_name string"),
        }
        dims |= {name: F.broadcast(dims[name]) for name in ("channel", "product_type")}
        if version == "latest":
            dims["product"] = dims["product"].filter("edition_id IS NOT NULL")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            # an edition of two current versions has a row for each of them under "latest"
            product = view(dims["product"], "product_key", "edition_id", version).collect()
            made = rollups._monthly_shown(states, dims, version)
            got = {(r["month_number"], r["edition_id"]): (r["transaction_count"], int(r["total_quantity"])) for r in made.collect()}
            plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        want = defaultdict(lambda: (0, 0))
        for r in rows:
            for p in product:
                if p["product_key"] == r[3]:
                    n, total = want[r[1], p["edition_id"]]
                    want[r[1], p["edition_id"]] = (n + r[6], total + int(r[7]))
        assert got == want and made.count() == len(want)
        if names is single:
            assert not [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and "channel_name" in line]
