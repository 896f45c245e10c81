import datetime as dt
import glob
import threading
from decimal import Decimal
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliomart.operators import quality
from foliomart.plans import pipeline
from foliomart.plans.rollups import monthly_sales_summary
from foliomart.schemas import FACT_DAILY, FACT_SALES
from foliomart.session import together
from foliomart.sources.extract import extract, extract_all, total_rows
from samples import DAILY, META, META_HEADER, SALES, SALES_HEADER, write_extracts

DAY = dt.date(2023, 1, 1)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    paths = write_extracts(folder)
    root = str(tmp_path_factory.mktemp("warehouse"))
    return pipeline.run(spark, root, paths, DAY), paths


def reasons(warehouse, source, key):
    return {r[key]: r["reject_reason"] for r in warehouse.read(f"rejected/{source}").collect()}


def test_extract_keeps_text_and_counts_rows(spark, tmp_path):
    paths = write_extracts(tmp_path)
    extracts = extract_all(spark, paths)
    rows, meta = extracts["raw_sales"]
    assert {d for _, d in rows.dtypes} == {"string"}
    line = meta.first()
    assert (line["file_name"], line["total_rows"]) == ("sales.csv", len(SALES))
    assert line["columns"] == rows.columns and line["file_size_bytes"] > 0
    assert total_rows(extracts).first()[0] == len(SALES) + len(DAILY) + len(META)


def test_extract_names_missing_columns(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("SaleNum,DateStamp\nS1,2024-01-01\n")
    with pytest.raises(ValueError, match="Curr"):
        extract(spark, str(path), "raw_sales")


def test_sales_measures_round_at_every_step(loaded):
    warehouse, _ = loaded
    row = warehouse.read("fact_sales", FACT_SALES).filter("sale_number = 'S7301'").first()
    expected = {
        "time_key": 20240314, "unit_price_gbp": "15.73", "gross_amount_gbp": "1887.60",
        "discount_amount_gbp": "226.51", "net_amount_gbp": "1661.09", "unit_cost_gbp": "3.25",
        "total_cost_gbp": "390.00", "gross_profit_gbp": "1271.09", "gross_margin_pct": "76.52",
    }
    for name, value in expected.items():
        assert row[name] == (Decimal(value) if isinstance(value, str) else value), name
    assert row["source_system"] == "RAW_SALES" and row["load_batch_id"] == 1


def test_sales_reasons(loaded):
    warehouse, _ = loaded
    # three rows were invalid already in staging and never reached the load
    assert reasons(warehouse, "raw_sales", "sale_num") == {
        "S0002": "DUPLICATE",
        "S0005": "NO_TIME_KEY",
        "S0008": "CK_SALES_QTY_POSITIVE",
        "S0009": "CK_SALES_DISCOUNT",
        "S0010": "OVERFLOW_GROSS_MARGIN_PCT",
    }
    staged = pipeline.staged_table(warehouse, "raw_sales")
    invalid = {r["sale_num"]: r["validation_errors"] for r in staged.filter("validation_status = 'INVALID'").collect()}
    assert set(invalid) == {"S0006", "S0007"}
    assert "date not readable" in invalid["S0006"] and "tqty" in invalid["S0007"]


def test_intermediate_tables_are_gone(loaded):
    warehouse, _ = loaded
    assert not glob.glob(f"{warehouse.root}/work/*")


def test_unknown_members_keep_the_sale(loaded):
    warehouse, _ = loaded
    fact = {r["sale_number"]: r for r in warehouse.read("fact_sales", FACT_SALES).collect()}
    assert set(fact) == {"S7301", "S0002", "S0003", "S0011"}
    assert fact["S0003"]["product_key"] == -1 and fact["S0003"]["unit_cost_gbp"] == 0
    lost = fact["S0011"]
    assert (lost["channel_key"], lost["currency_key"], lost["product_type_key"]) == (-1, -1, -1)
    assert lost["unit_price_gbp"] == 1  # no rate: counts as the base currency
    assert sorted(r["sales_fact_key"] for r in fact.values()) == [100000, 100001, 100002, 100003]


def test_daily_measures_and_reasons(loaded):
    warehouse, _ = loaded
    fact = {r["time_key"]: r for r in warehouse.read("fact_daily", FACT_DAILY).collect()}
    assert set(fact) == {20230214, 20230125}
    row = fact[20230214]
    for name, value in {
        "unit_binding_cost": "2.6250", "cost_of_goods_sold": "2362.50", "gross_profit_gbp": "11637.50",
        "gross_margin_pct": "83.13", "print_run_utilization": "75.00", "return_rate_pct": "4.44",
    }.items():
        assert row[name] == Decimal(value), name
    assert row["net_units"] == 860
    assert fact[20230125]["net_units"] == 507 and fact[20230125]["returns_qty"] == -7
    why = {(r["date_stamp"], r["stn_code"], r["pd"]): r["reject_reason"]
           for r in warehouse.read("rejected/raw_daily").collect()}
    assert sorted(why.values()) == [
        "CK_DAILY_TEMP", "DUPLICATE", "NO_DC", "OVERFLOW_PRINT_RUN_UTILIZATION",
    ]


def test_logs_and_findings(loaded):
    warehouse, _ = loaded
    batch = warehouse.batches().first()
    assert (batch["status"], batch["records_processed"]) == ("COMPLETED", 6)
    assert {r["status"] for r in warehouse.steps().collect()} == {"COMPLETED"}
    found = {r["validation_rule"]: r for r in quality.issues(warehouse.quality()).collect()}
    assert found["positive:RV"]["error_details"] == "RV: 1 values below zero"
    assert found["category:StnCode"]["invalid_records"] == 1


def test_rollups_hold_the_fact_totals(loaded):
    warehouse, _ = loaded
    fact = warehouse.read("fact_sales", FACT_SALES)
    net = fact.agg(F.sum("net_amount_gbp")).first()[0]
    rollup = warehouse.current("rollup/channel_performance")
    assert rollup.agg(F.sum("net_revenue_gbp")).first()[0] == net
    assert warehouse.current("rollup/monthly_sales_summary").agg(F.sum("transaction_count")).first()[0] == 4


def test_later_life(spark, loaded, tmp_path):
    """A second batch with a changed title, archive, truncation, then files that arrive one by one."""
    w, _ = loaded
    root = w.root
    changed = [META[0].replace("First Title", "New Title"), META[1]]
    pipeline.run(spark, root, write_extracts(tmp_path, meta=changed), dt.date(2024, 7, 28))
    assert w.read("fact_sales", FACT_SALES).count() == 4
    assert w.read("fact_daily", FACT_DAILY).count() == 2
    versions = w.current("dim/product").filter("edition_id = 'E1'").orderBy("record_version").collect()
    assert [(v["product_title"], v["is_current"], v["expiry_date"]) for v in versions] == [
        ("First Title", "N", dt.date(2024, 7, 27)),
        ("New Title", "Y", None),
    ]
    assert w.current("dim/product").count() == 3

    # the facts of the expired version drop out, unless seen through the natural key
    fact, dims = w.read("fact_sales", FACT_SALES), pipeline.star(w)
    recorded = monthly_sales_summary(fact, dims)
    latest = monthly_sales_summary(fact, dims, "latest")
    assert recorded.filter("edition_id = 'E1'").count() == 0
    assert {r["product_title"] for r in latest.filter("edition_id = 'E1'").collect()} == {"New Title"}

    assert pipeline.archive_processed(spark, root) == 6
    assert pipeline.archive_processed(spark, root) == 0
    assert w.read("archive/raw_sales").filter("processed_flag = 'Y'").count() == 4
    pipeline.truncate_staging(spark, root)
    assert pipeline.staged_table(w, "raw_sales").count() == 0

    folder = tmp_path / "arrivals"
    folder.mkdir()
    (folder / "one.csv").write_text(f"{SALES_HEADER}\n{SALES[0]}\nA1,2024-08-01,E1,CH001,1,9.99,GBP,,10,5.00,5.0,Hardcover\n")
    state = str(tmp_path / "state")
    pipeline.run_incremental(spark, root, {"raw_sales": str(folder)}, state)
    (folder / "two.csv").write_text(f"{SALES_HEADER}\nA2,2024-08-02,E2,CH002,1,9.99,GBP,,10,5.00,5.0,Paperback\n")
    pipeline.run_incremental(spark, root, {"raw_sales": str(folder)}, state)
    fact = w.read("fact_sales", FACT_SALES)
    assert {r[0] for r in fact.filter("time_key > 20240731").select("sale_number").collect()} == {"A1", "A2"}
    assert fact.agg(F.max("sales_fact_key"), F.count("*")).first() == (100005, 6)
    staged = pipeline.staged_table(w, "raw_sales").groupBy("source_filename").count().collect()
    assert {(r[0].rsplit("/", 1)[1].split("@")[0], r[1]) for r in staged} == {("one.csv", 2), ("two.csv", 1)}
    names = {r["batch_name"] for r in w.batches().filter("status = 'COMPLETED'").collect()}
    assert names == {"FULL_LOAD", "ARCHIVE_STAGING", "TRUNCATE_STAGING", "INCREMENTAL_LOAD"}


def line(number, edition, day="2024-08-01", price="9.99"):
    return f"{number},{day},{edition},CH001,1,{price},GBP,,10,5.00,5.0,Hardcover"


def test_mixed_arrivals_and_new_meta(spark, tmp_path):
    """Files seen by the full load, new ones, equal names in two folders, and meta before its sale."""
    root, state = str(tmp_path / "w"), str(tmp_path / "state")
    for name in ("sales/a", "sales/b", "meta"):
        (tmp_path / "in" / name).mkdir(parents=True)

    def deliver(name, *lines, header=SALES_HEADER):
        (tmp_path / "in" / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

    deliver("sales/a/one.csv", line("A1", "E1"), line("A2", "E77"))
    deliver("meta/first.csv", *META, header=META_HEADER)
    folders = {"raw_meta": str(tmp_path / "in/meta"), "raw_sales": str(tmp_path / "in/sales/*")}
    w = pipeline.run(spark, root, folders, DAY, days=(dt.date(2023, 1, 1), dt.date(2024, 12, 31)))
    assert w.current("dim/time").count() == 731

    # one more file in each folder, one of a name seen before; the edition sold before is now known
    deliver("sales/b/one.csv", line("A3", "E77", price="9.1234567"))
    deliver("sales/a/two.csv", line("A4", "E1"), line("A1", "E1"), line("A6", "E1", day="2025-05-05"))
    deliver("meta/second.csv", META[0].replace("E1,First", "E77,Seventh").replace("V001", "V003"), header=META_HEADER)
    for _ in range(2):
        pipeline.run_incremental(spark, root, folders, state, DAY, days=(dt.date(2023, 1, 1), dt.date(2025, 12, 31)))
    fact = {r["sale_number"]: r for r in w.read("fact_sales", FACT_SALES).collect()}
    assert set(fact) == {"A1", "A2", "A3", "A4", "A6"}
    seventh = w.current("dim/product").filter("edition_id = 'E77'").first()
    assert fact["A2"]["product_key"] == -1 and fact["A3"]["product_key"] == seventh["product_key"]
    assert fact["A3"]["unit_price_gbp"] == Decimal("9.12")
    assert pipeline.staged_table(w, "raw_sales").count() == 6
    assert w.current("dim/time").count() == 1096
    # the duplicate is written down once, and nothing half done is left
    refused = w.read("rejected/raw_sales").collect()
    assert [(r["sale_num"], r["reject_reason"]) for r in refused] == [("A1", "DUPLICATE")]
    assert not glob.glob(f"{root}/work/*") and len(glob.glob(f"{root}/dim/product/v=*")) == 2
    total = w.current("rollup/channel_performance").groupBy("year").agg(F.sum("transaction_count")).collect()
    assert {tuple(r) for r in total} == {(2024, 4), (2025, 1)}

    # a file that staging forgot is still known, and rates come with a later load
    pipeline.truncate_staging(spark, root)
    deliver("sales/a/three.csv", line("A5", "E1").replace("GBP", "USD"))
    rates = spark.createDataFrame(
        [("USD", "GBP", "2024-08-01", "0.5", "bank"), ("USD", "GBP", "2024-08-02", "123456789", "bank"),
         ("XXX", "GBP", "2024-08-01", "1", "bank"), ("USD", "GBP", "soon", "1", "bank")],
        "from_code string, to_code string, rate_date string, exchange_rate string, rate_source string",
    )
    pipeline.run_incremental(spark, root, folders, str(tmp_path / "other"), DAY, rates=rates)
    fact = {r["sale_number"]: r for r in w.read("fact_sales", FACT_SALES).collect()}
    assert len(fact) == 6 and fact["A5"]["unit_price_gbp"] == Decimal("5.00")
    why = {r["rate_date"] + r["from_code"]: r["reject_reason"] for r in w.read("rejected/exchange_rate").collect()}
    assert why == {"2024-08-02USD": "RATE_DOES_NOT_FIT", "2024-08-01XXX": "UNKNOWN_FROM_CURRENCY", "soonUSD": "NO_DATE"}


def test_loads_read_the_months_of_the_batch(spark, loaded):
    from foliomart.sources.warehouse import in_months, months_of

    w, _ = loaded
    days = spark.createDataFrame([(dt.date(2023, 1, 25),), (None,), (dt.date(2023, 1, 2),)], "date_parsed date")
    assert months_of(days) == [202301]
    fact = in_months(w.read("fact_daily", FACT_DAILY), [202301])
    plan = fact._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "year_month" in filters and "202301" in filters
    assert in_months(w.read("fact_daily", FACT_DAILY), []).count() == 0


def test_failure_is_logged_and_raised(spark, tmp_path):
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load = pipeline.Load(w, "BROKEN")

    def fail():
        raise RuntimeError("no such file")

    with pytest.raises(RuntimeError):
        load.run(lambda: load.step("read", fail))
    assert w.batches().first()["status"] == "FAILED"
    assert w.steps().first()["error_message"] == "no such file"


def test_a_rerun_finishes_a_stopped_load(spark, tmp_path, monkeypatch):
    """Stopped before the facts, then before the rollups: the next call finds no file and does the rest."""
    root, state = str(tmp_path / "w"), str(tmp_path / "state")
    for name in ("sales", "meta"):
        (tmp_path / "in" / name).mkdir(parents=True)
    (tmp_path / "in/meta/m.csv").write_text("\n".join([META_HEADER, *META]) + "\n", encoding="utf-8")
    (tmp_path / "in/sales/a.csv").write_text(f"{SALES_HEADER}\n{line('A1', 'E1')}\n")
    folders = {"raw_meta": str(tmp_path / "in/meta"), "raw_sales": str(tmp_path / "in/sales")}
    w = pipeline.run(spark, root, folders, DAY)

    def stopped(*_, **__):
        raise RuntimeError("stopped")

    def rolled_up():
        return w.current("rollup/channel_performance").agg(F.sum("transaction_count")).first()[0]

    for step, number in (("load_facts", "A2"), ("refresh_rollups", "A3")):
        (tmp_path / f"in/sales/{number}.csv").write_text(f"{SALES_HEADER}\n{line(number, 'E1')}\n")
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="stopped"):
            patch.setattr(pipeline, step, stopped)
            pipeline.run_incremental(spark, root, folders, state, DAY)
        pipeline.run_incremental(spark, root, folders, state, DAY)
        n = int(number[1])
        assert w.read("fact_sales", FACT_SALES).count() == n and rolled_up() == n
    before = w.steps().count()
    pipeline.run_incremental(spark, root, folders, state, DAY)
    assert {r["step_name"] for r in w.steps().orderBy(F.desc("batch_id")).limit(w.steps().count() - before).collect()} == {"dimensions"}


def test_only_open_portions_are_read(spark, tmp_path):
    """Settled portions are not looked at again; rejects come back when a dimension changed, all if a load stopped."""
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load = pipeline.Load(w, "TEST")
    rows, _ = extract(spark, write_extracts(tmp_path)["raw_sales"], "raw_sales")
    for _ in range(2):
        pipeline.stage_rows(load, "raw_sales", rows)
    load.book.note("raw_sales", 1, "TRIED")

    def todo(of=None):
        return pipeline.to_load(of or load, "fact_sales", "raw_sales")

    first = todo()
    assert first.portions == [2] and first.old is None and not first.broken
    files = {r[0] for r in first.rows.select(F.input_file_name()).distinct().collect()}
    assert files and all("stage_batch=2/" in f for f in files)
    load.book.note("raw_sales", 2, "TRIED")
    assert todo().rows is None

    low = pipeline.staged_table(w, "raw_sales", [1]).agg(F.min("stg_sales_id")).first()[0]
    w.replace("ledger/raw_sales", spark.createDataFrame([(low, 1, "NO_TIME_KEY")], "stg_sales_id bigint, stage_batch int, reject_reason string"))
    load.book.note("refused/raw_sales", 0, "TRIED", str(load.book.next("dimensions")))
    assert todo().rows is None
    load.book.note("dimensions", load.book.next("dimensions"), "CHANGED")
    assert [r["stg_sales_id"] for r in todo(pipeline.Load(w, "NEXT")).rows.collect()] == [low]

    load.book.note("raw_sales", 2, "LOADING")
    stopped = todo(pipeline.Load(w, "LATER"))
    assert stopped.broken and stopped.portions == [2] and stopped.rows.count() == len(SALES) + 1


def test_unfinished_portions_are_forgotten(spark, tmp_path):
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load = pipeline.Load(w, "TEST")
    rows, _ = extract(spark, write_extracts(tmp_path)["raw_sales"], "raw_sales")
    pipeline.stage_rows(load, "raw_sales", rows)
    load.book.note("raw_sales", 1, "STARTED")  # as if the confirmation had not come
    after = pipeline.Load(w, "AFTER")
    assert pipeline.delivered(after, "raw_sales").count() == 0
    pipeline.discard_unfinished(after)
    assert pipeline.staged_table(w, "raw_sales").count() == 0 and after.book.numbers("raw_sales", "DISCARDED") == [1]
    pipeline.stage_rows(after, "raw_sales", rows)
    assert after.book.numbers("raw_sales", "STAGED") == [2] and pipeline.delivered(after, "raw_sales").count() == 1


def test_facts_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    """Neither fact waits for the end of the other, and both are logged under a step of their own."""
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    both = threading.Barrier(2, timeout=60)

    def meet(load, table, *_):
        both.wait()
        return {"fact_sales": (3, 1), "fact_daily": (2, 0)}[table]

    monkeypatch.setattr(pipeline, "_load_fact", meet)
    monkeypatch.setattr(pipeline, "star", lambda _: {})
    load = pipeline.Load(w, "SIDE_BY_SIDE")
    assert pipeline.load_facts(load) == (5, 1)
    steps = w.steps().filter(F.col("batch_id") == load.batch_id).collect()
    assert sorted((r["step_id"], r["status"]) for r in steps) == [(1, "COMPLETED"), (2, "COMPLETED")]


def test_lines_written_side_by_side_are_kept(spark, tmp_path):
    """Appends to one table come in turn; all works end before the first failure is raised."""
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load = pipeline.Load(w, "TEST")
    together(*[partial(load.book.note, "raw_sales", n, "STAGED", figure=n) for n in range(8)])
    assert pipeline.Ledger(w).numbers("raw_sales", "STAGED") == list(range(8))
    assert w.read("log/ledger").select("seq").distinct().count() == 8
    ended = []

    def fail():
        raise RuntimeError("first")

    with pytest.raises(RuntimeError, match="first"):
        together(fail, lambda: w.append("t", spark.range(3)), lambda: ended.append(1))
    assert ended == [1] and w.read("t").count() == 3 and together() == []


def test_notes_start_no_python_worker(spark, tmp_path, monkeypatch):
    """Ledger lines are literals, and several are one write."""
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load, written = pipeline.Load(w, "TEST"), []
    append = w.append
    monkeypatch.setattr(w, "append", lambda table, df: (written.append(df), append(table, df)))
    load.book.note("raw_sales", [1, 2], "STAGED", figure=7)
    load.book.note_all([("raw_sales", 2, "LOADING"), ("fact_sales", 1, "STARTED", "202301"), ("raw_daily", [], "TRIED")])
    assert len(written) == 2 and not any("ExistingRDD" in df._jdf.queryExecution().toString() for df in written)
    book = pipeline.Ledger(w)
    assert (book.numbers("raw_sales", "STAGED"), book.numbers("raw_sales", "LOADING"), book.top("raw_sales")) == ([1], [2], 7)
    assert book.detail("fact_sales", 1) == "202301" and book.numbers("raw_daily") == []


def test_arrivals_are_listed_and_known_files_not_read(spark, tmp_path):
    folder, log = tmp_path / "in", pipeline.Load(pipeline.Warehouse(spark, str(tmp_path / "w")), "TEST")
    folder.mkdir()
    (folder / "new [1] {a}.csv").write_text(f"{SALES_HEADER}\n{line('A1', 'E1')}\n")
    (folder / "empty.csv").write_text("")
    (folder / "broken.csv.gz").write_bytes(b"not a gzip file")  # fails as soon as it is opened
    seen = set()
    pipeline.stream_stage(spark, str(folder), str(tmp_path / "state"), lambda files, _: seen.update(r[0] for r in files.collect())).awaitTermination()
    assert len(seen) == 2 and not any("empty" in name for name in seen)
    rows = pipeline.rows_of_files(spark, str(folder), "raw_sales", [name for name in seen if "broken" not in name])
    assert pipeline.stage_rows(log, "raw_sales", rows, F.col("_file")) == (1, 0)
    assert {r[0] for r in pipeline.delivered(log, "raw_sales").collect()} < set(seen)
    assert pipeline.rows_of_files(spark, str(folder), "raw_sales", []).isEmpty()


def test_old_rejects_are_looked_up_once(spark, tmp_path):
    w = pipeline.Warehouse(spark, str(tmp_path / "w"))
    load = pipeline.Load(w, "TEST")
    rows, _ = extract(spark, write_extracts(tmp_path)["raw_sales"], "raw_sales")
    pipeline.stage_rows(load, "raw_sales", rows)
    low = pipeline.staged_table(w, "raw_sales", [1]).agg(F.min("stg_sales_id")).first()[0]
    w.replace("ledger/raw_sales", spark.createDataFrame([(low, 1, "NO_TIME_KEY")], "stg_sales_id bigint, stage_batch int, reject_reason string"))
    load.book.note_all([("raw_sales", 1, "TRIED"), ("refused/raw_sales", 0, "TRIED", "1"), ("dimensions", 1, "CHANGED")])
    todo = pipeline.to_load(load, "fact_sales", "raw_sales", w.path("work/test"))
    plan = todo.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and [r["stg_sales_id"] for r in todo.rows.collect()] == [low]
    assert [tuple(r) for r in todo.old.collect()] == [(low, 1, "NO_TIME_KEY")]


@pytest.mark.parametrize("way", ["run", "run_incremental"])
def test_dimensions_do_not_wait_for_the_other_extracts(spark, tmp_path, monkeypatch, way):
    begun, waited = threading.Event(), []

    def stage(load, source, *_):
        if source == "raw_sales":
            waited.append(begun.wait(30))
        return 0, 0

    def stopped(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline, "stage_rows", stage)
    monkeypatch.setattr(pipeline, "refresh_dimensions", lambda *_, **__: begun.set() or 0)
    monkeypatch.setattr(pipeline, "load_facts", stopped)
    monkeypatch.setattr(pipeline, "left_to_load", lambda _: True)
    paths = {"raw_meta": str(tmp_path / "meta"), "raw_sales": str(tmp_path / "sales")}
    for path, rows in zip(paths.values(), ([META_HEADER, *META], [SALES_HEADER, *SALES]), strict=True):
        Path(path).mkdir()
        (Path(path) / "a.csv").write_text("\n".join(rows) + "\n", encoding="utf-8")
    with pytest.raises(RuntimeError, match="stopped"):
        if way == "run":
            pipeline.run(spark, str(tmp_path / "w"), paths, DAY)
        else:
            pipeline.run_incremental(spark, str(tmp_path / "w"), paths, str(tmp_path / "state"), DAY)
    assert waited == [True]
