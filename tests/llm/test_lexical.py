import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliomart.llm import lexical
from tests.llm import brute
from tests.llm.conftest import WORDS

COLUMNS = ["item_id", "rank", "doc_id", "score"]


@pytest.fixture(scope="module")
def asked(rows):
    rnd = random.Random(2)
    texts = [t for _, t, *_ in rows if t and len(t.split()) > 9]
    found = [(i, " ".join(rnd.sample(rnd.choice(texts).split(), 5))) for i in range(12)]
    found += [(50, " ".join(rnd.sample(WORDS, 150))), (51, None), (52, ""), (53, "no-such-word ever0"), (54, "UPPER Two wORDS"), (None, "a b c")]
    return found + [(3, "spam"), (60, "é ü ſ ß")]


def test_best_documents_are_those_of_brute_force(spark, docs, rows, asked, got):
    items = spark.createDataFrame(asked, "item_id long, text string")
    expected = brute.op13([(d, t) for d, t, *_ in rows], asked)
    assert got(lexical.search(docs, items), *COLUMNS) == expected
    assert got(lexical.search(docs.repartition(11), items, item_chars=60), *COLUMNS) == expected


def test_equal_scores_repeated_rows_and_null_ids(spark, got):
    rows = [(i % 7, "red fox") for i in range(40)] + [(None, "red fox"), (None, "Red_Fox"), (9, "red"), (9, None), (None, None), (8, "fox " * 3)]
    asked = [(1, "red fox"), (2, "fox"), (1, "fox blue"), (3, "blue")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(asked, "item_id long, text string")
    for k in (1, 3, 10, 100):
        assert got(lexical.search(df, items, k=k), *COLUMNS) == brute.op13(rows, asked, k)


def test_empty_tables_and_clashing_columns(spark, docs, nothing, asked, got):
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    names = ("doc", "n", "terms", "tfs", "score", "rank", "part", "item_id", "term")
    wide = docs.select("*", *[F.lit("x").alias(c) for c in names])
    many = items.select("*", *[F.lit("x").alias(c) for c in ("doc_id", "doc", "score", "rank")])
    assert got(lexical.search(wide, many), *COLUMNS) == got(lexical.search(docs, items), *COLUMNS)


def batch_of(texts, number):
    counts = [[(number[t], n) for t, n in brute.Counter(brute.lexical_terms(x)).items() if t in number] for x in texts]
    sizes = [len(brute.lexical_terms(x)) for x in texts]
    lists = [pa.array([[p[i] for p in c] for c in counts], pa.list_(kind)) for i, kind in ((0, pa.int32()), (1, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=lexical._ROWS), sum(sizes)


def test_masks_group_documents_by_the_terms_they_hold():
    number = {f"w{i}": i for i in range(70)}
    texts = ["w0 w69", "w0 w69 w0", "w1", "", "w69 w64 w63"]
    batch, total = batch_of(texts, number)
    distinct, docs, starts = lexical.masks(lexical.Postings(batch, 70, 4, total), np.arange(70))
    groups = sorted(sorted(docs[a:b].tolist()) for a, b in zip(starts, starts[1:]))
    assert groups == [[0, 1], [2], [4]] and distinct.shape == (3, 2)


def test_stops_before_all_groups_are_scored():
    rnd = random.Random(5)
    number = {w: i for i, w in enumerate(sorted({t for w in WORDS for t in brute.lexical_terms(w)}))}
    texts = [" ".join(rnd.choices(list(number), k=60)) for _ in range(3000)]
    batch, total = batch_of(texts, number)
    postings = lexical.Postings(batch, len(number), len(texts), total)
    terms, best = np.array(rnd.sample(range(len(number)), 20)), lexical.Best(10)
    ids, unnamed = np.arange(len(texts)), np.zeros(len(texts), bool)
    scored = lexical.look(postings, ids, unnamed, np.sort(terms), np.full(20, 2000), best)
    assert 0 < scored < 1500
    every = lexical._scores(postings, np.sort(terms), np.full(20, 2000), ids)
    assert best.scores.tolist() == sorted(every.tolist(), reverse=True)[:10]


def test_long_texts_are_cut_between_terms(monkeypatch):
    raw = ("ab é1 " * 50).encode()
    monkeypatch.setattr(lexical, "SLICE", 7)
    assert [t for part in lexical.terms_of(raw) for t in part] == ["ab".encode(), "é1".encode()] * 50
