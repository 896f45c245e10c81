import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from foliomart.llm import repair
from tests.llm import brute

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed, n, most, kinds="ssuuuuaaaax"):
    rnd = random.Random(seed)
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, most)):
            text = rnd.choice(["Yes.", "No!", "", " \n", "cut", "Why?", f"own {rnd.random()}.", f"cut {rnd.random()}", "end. \n"])
            rows.append((conv, turn + rnd.randint(0, 1), names[rnd.choice(kinds)], text))
    rnd.shuffle(rows)
    return rows


def check(spark, got, rows, chunk=repair.CHUNK):
    df = spark.createDataFrame(rows, ROWS)
    assert got(repair.report(df, df, chunk), *COLUMNS) == brute.op12(rows, {r[0] for r in rows})


def test_repairs_are_those_of_brute_force(spark, got):
    check(spark, got, conversations(1, 120, 12))


def test_chunks_change_nothing(spark, got):
    check(spark, got, conversations(2, 12, 60), chunk=3)


def test_long_runs_that_change_nothing_settle(spark, got):
    """Deleted turns pass every vector on: chunks of them settle in a few passes, from both sides."""
    rows = [(1, i, "user", "same.") for i in range(150)] + [(1, 150 + i, "assistant", f"t{i}") for i in range(60)]
    rows += [(1, 300, "user", "at last."), (2, 0, "assistant", "first.")] + [(2, 1 + i, "tool", "") for i in range(90)]
    rows += [(3, i, "ua"[i % 2], f"{i}.") for i in range(80)] + [(4, None, "tool", f"{i}") for i in range(70)]
    check(spark, got, rows, chunk=4)


def test_walks_find_the_least_of_all_rows_of_edits():
    """Backward vectors and tracing against every row of edits with up to two inserts at a place, without Spark."""
    rnd = random.Random(9)
    legal = re.compile("(s?(ua)+)?")
    for _ in range(60):
        symbols = [rnd.randrange(16) for _ in range(rnd.randint(0, 3))]
        best = None
        for plan in itertools.product(["D", "K", "u", "a"], repeat=len(symbols)):
            if any(s % 4 in (repair.BLANK, repair.DUPLICATE) and e != "D" for s, e in zip(symbols, plan)):
                continue
            for added in itertools.product(["", "u", "a", "ua", "au"], repeat=len(symbols) + 1):
                said = "".join(i + ("suax"[s // 4] if e == "K" else e if e != "D" else "") for i, s, e in zip(added, symbols, plan)) + added[-1]
                if legal.fullmatch(said):
                    cost = sum(5 * len(i) for i in added) + sum({"D": 2, "K": 0}.get(e, 1) for e in plan)
                    cost += sum(5 for s, e in zip(symbols, plan) if s % 4 == repair.TRUNCATED and e != "D")
                    audit = "".join("I" * len(i) + (e if e in "DK" else "R") for i, e in zip(added, plan)) + "I" * len(added[-1])
                    best = min(best or (cost, audit), (cost, audit))
        state, audit, cost = repair.START, "", 0
        for symbol, vector in zip(symbols, repair._walk(symbols, repair.NUMBER[repair.END])):
            done, state, paid = repair.edits(symbol, state, vector)
            audit, cost = audit + done[::2], cost + paid
        done, paid = repair.closing(state)
        assert (cost + paid, audit + done[::2]) == best


def test_a_chunk_forgets_what_is_right_of_it():
    good = [1 * 4, 2 * 4] * 6
    assert len(set(repair._speculated(good))) == 1
    assert len(set(repair._speculated([repair.BLANK] * 6))) == len(repair.VECTORS)
    assert len(repair.VECTORS) == 21 and repair.END == (0, 10, 5, 0)


def test_odd_rows(spark, got):
    """Nulls in any column, empty roles, repeated rows, conversations without rows."""
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (None, 2, "assistant", "b"), (None, None, "", "x."), (5, None, "user", None),
        (6, 3, "", "x."), (6, 3, "", "x."), (6, None, "User", "y."), (7, 1, "user", "é." * 1000), (7, 1, "user", "é." * 1000),
        (8, -5, "system", "s."), (8, 5, "system", "s."), (9, 1, "us", " "), (9, 2, "ai", "ok."),
    ]
    check(spark, got, rows, chunk=2)
    empty = spark.createDataFrame([], ROWS)
    df = spark.createDataFrame(rows, ROWS)
    assert repair.report(empty, empty).count() == 0
    names = ("conversation", "row", "part", "digest", "copy", "symbol", "edits", "cost", "link", "map")
    wide = df.select("*", *[F.lit("x").alias(c) for c in names])
    assert got(repair.report(wide, wide), *COLUMNS) == got(repair.report(df, df), *COLUMNS)
    found = got(repair.report(empty, df), *COLUMNS)
    assert {r[1:8] for r in found} == {(0, 0, 0, 0, 0, 0, "")} and len(found) == len({r[0] for r in rows})


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two! x") for c in (1, 2, None) for t in (*range(40), None)] + [(3, 1, None, None)]
    found = repair.damaged(spark.createDataFrame(rows, ROWS)).collect()
    expected = []
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role, {1: "", 2: text.replace(".", "").replace("!", "")}.get(kind, text))
        expected += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_edits_are_rows(spark):
    rows = conversations(4, 1, 30)
    found = repair.repair(spark.createDataFrame(rows, ROWS)).edits.orderBy("row", "part").collect()
    [expected] = brute.op12(rows, [0])
    lines = [f"{r['role']}:{r['text']}" for r in found if r["edit"] != "D"]
    assert "".join(r["edit"] for r in found) == expected[7]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == expected[8]
