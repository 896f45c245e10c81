import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from foliomart.operators import dimensions as dims
from foliomart.operators import keys, lookups
from foliomart.operators.keys import assign_keys, first_valid
from foliomart.operators.scd2 import as_of_versions, scd2_history, scd2_merge

DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def test_first_valid_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(400)}", days(rng.randrange(9)), i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, d date, id int")
    existing = spark.createDataFrame([("k1",), ("k2",)], "k string")
    kept, rest = first_valid(df, ["k"], ["d", "id"], existing)
    best = {}
    for k, d, i in rows:
        if k not in ("k1", "k2"):
            best[k] = min(best.get(k, (d, i)), (d, i))
    assert {r["k"]: (r["d"], r["id"]) for r in kept.collect()} == best
    assert kept.count() + rest.count() == 3000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_later_rows_know_keys_of_another_type(spark, tmp_path):
    df = spark.createDataFrame([(1, DAY, 1), (2, DAY, 2), (3, DAY, 3), (3, DAY, 4)], "k int, d date, id int")
    existing = spark.createDataFrame([(2,), (1 << 40,)], "k bigint")
    later = keys.later_rows(df, ["k"], ["d", "id"], str(tmp_path), existing)
    assert sorted(r["id"] for r in later.collect()) == [2, 4]


@pytest.mark.parametrize("pieces", [None, 3, 50])
def test_keys_follow_day_and_id_without_gaps(spark, pieces):
    rng = random.Random(3)
    # one day holds most rows, some rows have no day
    rows = [(None if i % 50 == 0 else DAY if i % 4 else days(rng.randrange(1, 5)), i * 7) for i in range(1000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "d date, id bigint")
    got = {r["id"]: r["key"] for r in assign_keys(df, "d", "id", "key", 500, pieces).collect()}
    order = sorted(rows, key=lambda r: (r[0] or dt.date(1000, 1, 1), r[1]))
    assert got == {r[1]: 500 + i for i, r in enumerate(order)}


def test_keys_of_text_ids_are_dense_and_stable(spark):
    df = spark.createDataFrame([(days(i % 3), f"id{i}") for i in range(500)], "d date, id string")
    first = {r["id"]: r["key"] for r in assign_keys(df, "d", "id", "key", 1).collect()}
    again = {r["id"]: r["key"] for r in assign_keys(df.repartition(7), "d", "id", "key", 1, 1024).collect()}
    assert sorted(first.values()) == list(range(1, 501)) and first == again


def test_sparse_ids_of_one_hot_day_are_few_even_pieces(spark, monkeypatch):
    monkeypatch.setattr(keys, "PIECE_ROWS", 100)
    df = spark.range(3000).select(F.lit(DAY).alias("d"), (F.col("id") * 1_000_000_007).alias("id"))
    made = assign_keys(df, "d", "id", "key", 1)
    assert [r["key"] for r in made.orderBy("id").collect()] == list(range(1, 3001))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_crowded_ids_make_even_pieces(spark, monkeypatch, tmp_path):
    """90 % of a day's ids lie in 1 % of their range."""
    monkeypatch.setattr(keys, "PIECE_ROWS", 500)
    crowd = spark.range(18000).select(F.lit(DAY).alias("d"), (F.col("id") + 5_000_000).alias("id"))
    wide = spark.range(2000).select(F.lit(DAY).alias("d"), (F.col("id") * 1000 + 7_000_000_000).alias("id"))
    work = str(tmp_path / "work")
    made = assign_keys(crowd.union(wide).repartition(8), "d", "id", "key", 1, work=work)
    assert [r["key"] for r in made.orderBy("id").collect()] == list(range(1, 20001))
    sizes = spark.read.parquet(work).groupBy(F.shiftright("_at", 33)).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 2 * 500 and sizes[1] >= 20


def test_no_rows_get_no_keys(spark):
    df = spark.createDataFrame([], "d date, id bigint")
    assert assign_keys(df, "d", "id", "key", 1).collect() == []


def merge(current, incoming, day):
    return scd2_merge(current, incoming, "k", ["a", "b"], F.lit(day), "key", 1000)


VERSIONS = (
    "key bigint, k string, a string, b int, effective_date date, expiry_date date, is_current string,"
    " record_version int"
)


def test_merge(spark, frame):
    nothing = spark.createDataFrame([], VERSIONS)
    first = merge(nothing, frame("k string, a string, b int", ("x", "1", None), ("y", "1", 1)), DAY)
    second = merge(
        first, frame("k string, a string, b int", ("x", "1", None), ("y", "2", 1), ("z", None, 9)), days(10)
    )
    got = {(r["k"], r["record_version"]): r for r in second.collect()}
    assert set(got) == {("x", 1), ("y", 1), ("y", 2), ("z", 1)}
    assert got["x", 1]["is_current"] == "Y"  # null equals null: unchanged
    assert (got["y", 1]["expiry_date"], got["y", 1]["is_current"]) == (days(9), "N")
    assert (got["y", 2]["effective_date"], got["y", 2]["a"]) == (days(10), "2")
    assert sorted(r["key"] for r in got.values()) == [1000, 1001, 1002, 1003]
    # absent keys stay, an older extract is ignored, one of the same day corrects
    third = merge(second, frame("k string, a string, b int", ("y", "old", 0)), days(5))
    assert third.filter("a = 'old'").count() == 0 and third.count() == 4
    fixed = merge(second, frame("k string, a string, b int", ("y", "3", 1)), days(10))
    now = fixed.filter("k = 'y' AND is_current = 'Y'").first()
    assert (now["a"], now["record_version"], now["key"]) == ("3", 2, got["y", 2]["key"]) and fixed.count() == 4


def test_history_against_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.choice("aab") + str(rng.randrange(3)), days(rng.randrange(25)), i, rng.choice(["O", "P", None]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k string, d date, seq int, s string")
    made = scd2_history(df, "k", ["s"], "d", ["seq"])
    want = []
    for k in {r[0] for r in rows}:
        last = {}
        for _, d, seq, s in sorted((r for r in rows if r[0] == k), key=lambda r: r[2]):
            last[d] = s
        changes = []
        for d in sorted(last):
            if not changes or changes[-1][1] != last[d]:
                changes.append((d, last[d]))
        for i, (d, s) in enumerate(changes):
            end = changes[i + 1][0] - dt.timedelta(days=1) if i + 1 < len(changes) else None
            want.append((k, s, d, end, "N" if end else "Y", i + 1))
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, want))
    # on any day a key has at most one version
    for n in (0, 12, 24):
        held = as_of_versions(made, F.lit(days(n)))
        assert held.groupBy("k").count().filter("count > 1").count() == 0


def test_equal_meta_rows_are_made_one_before_they_are_sorted(spark, frame):
    meta = frame(
        "station_id string, station_name string, station_region string, station_mgr string, station_address string",
        *[(f"S{i % 2}", "Hall" if i % 4 else "Yard", "West", None, "1 High Street, E1 8ZA") for i in range(40)], (None, "x", "x", "x", "x"),
    )
    rows = dims.dc_rows(meta)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # the hash aggregate lies below the sorting one, so it comes last
    assert plan.rindex("HashAggregate(") > plan.rindex("SortAggregate(")
    assert {(r["station_code"], r["station_name"], r["postcode"]) for r in rows.collect()} == {("S0", "Hall", "E1 8ZA"), ("S1", "Hall", "E1 8ZA")}


def test_many_keys_are_not_matched_beforehand(frame, monkeypatch):
    large = frame("k int, v int", *[(i, i) for i in range(9)])
    asked = frame("k int", (1,), (1,), (2,), (None,))
    assert sorted(r["k"] for r in lookups.matching(large, asked, ["k"]).collect()) == [1, 2]
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 2)
    made = lookups.matching(large, asked, ["k"])
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString() and made.columns == ["k"]
    assert large.join(made, "k", "left_semi").count() == 9


@pytest.mark.parametrize("hot", [5, 10**6])
def test_later_rows_of_many_keys_are_shuffled_once(spark, tmp_path, monkeypatch, hot):
    """More repeated keys than are broadcast, hot ones or none, known, equal and null ones."""
    monkeypatch.setattr(keys, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(keys, "HOT_ROWS", hot)
    plans = {}
    real = keys.saved
    monkeypatch.setattr(keys, "saved", lambda df, path: (plans.update({path.split("/")[-1]: df}), real(df, path))[1])
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]) if i % 3 == 0 else f"k{rng.randrange(60)}", days(rng.randrange(9)), i) for i in range(300)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "k string, d date, id int")
    for known in (None, ["k1", "k2", "a", "other"]):
        existing = None if known is None else spark.createDataFrame([(k,) for k in known], "k string")
        first = {}
        for k, d, i in rows:
            first[k] = min(first.get(k, (d, i)), (d, i))
        late = [r for r in rows if r[1:] != first[r[0]] or r[0] in (known or [])]
        got = keys.later_rows(df, ["k"], ["d", "id"], f"{tmp_path}/{known is None}", existing)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(late, key=repr)
        if known is None and hot > 300:
            plan = plans["later"]._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
