import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from foliomart.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, asked, k=5):
    """Brute force over rows (id, vector)."""
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((m * m).sum(1))
    out = {}
    for i, v in rows:
        if i in asked:
            q = np.array(v, np.float32).astype(np.float64)
            s = (m * q).sum(1) / (norm * math.sqrt((q * q).sum()))
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_all_cells_give_the_exact_answer(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = answers(ann.search(df, df.where("vec_id % 50 = 0"), candidates=10**9))
    want = exact(rows, {i for i in range(0, 400, 50)})
    assert {q: [v for _, v, _ in a] for q, a in found.items()} == {q: [v for v, _ in a] for q, a in want.items()}
    for q, a in found.items():
        assert [r for r, _, _ in a] == [1, 2, 3, 4, 5]
        assert [s for *_, s in a] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_recall(spark):
    """On the test table the cells walked hold at least nine of ten true neighbours."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()))
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    found = answers(ann.search(df, df.where("vec_id % 50 = 0")))
    want = exact(rows, {i for i, _ in rows if i % 50 == 0})
    hit = sum(len({v for _, v, _ in found[q]} & {v for v, _ in a}) for q, a in want.items())
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_walk_goes_by_summed_distance():
    rnd = np.random.default_rng(3)
    left, right = rnd.random(7), rnd.random(5)
    sizes = rnd.integers(0, 3, 35)
    cells = ann.walk(left, right, sizes, 10**9)
    assert sorted(cells) == np.flatnonzero(sizes).tolist()
    sums = [left[c // 5] + right[c % 5] for c in cells]
    assert sums == sorted(sums)
    some = ann.walk(left, right, sizes, 9)
    assert some == cells[: len(some)] and sizes[some].sum() >= 9 > sizes[some[:-1]].sum()


def test_copies_ties_and_vectors_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 300, 3)] + [(1, [2.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0]), (50, [0.0, 1.0, 0.0])]
    odd = [(400, None), (450, [0.0, 0.0, 0.0]), (500, [nan, 1.0, 0.0]), (550, [inf, 1.0, 0.0]), (600, [None, 1.0, 0.0]), (650, [1.0]),
           (None, [1.0, 0.0, 0.0]), (700, [])]
    df = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS id", "2 AS cell", "3 AS first")
    found = answers(ann.search(df, df.where("vec_id % 50 = 0"), candidates=10**9))
    assert set(found) == {0, 50, 150}
    assert [v for _, v, _ in found[0]] == [1, 3, 6, 9, 12] and [s for *_, s in found[0]] == [1.0] * 5
    assert [v for _, v, _ in found[150]] == [0, 1, 3, 6, 9]
    assert [(v, s) for _, v, s in found[50]] == [(0, 0.0), (1, 0.0), (3, 0.0), (6, 0.0), (9, 0.0)]


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], SCHEMA)
    assert [(r["query_id"], r["vec_id"]) for r in ann.search(df, df.where("vec_id = 0")).collect()] == [(0, 1)]
    one = df.where("vec_id = 0")
    assert ann.search(one, one).count() == 0
    none = df.limit(0)
    assert ann.search(none, none).count() == 0
    assert ann.search(df.withColumn("embedding", F.lit(None).cast("array<float>")), df).count() == 0
