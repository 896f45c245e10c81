from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from foliomart.llm import mixture
from tests.llm import brute

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def check(rows, found):
    size = {r["doc_id"]: len(brute.words(t)) for r in found for d, t, *_ in rows if d == r["doc_id"]}
    by = defaultdict(list)
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, s))
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    for s, n, target in zip(order, sizes, brute.targets(sizes)):
        assert {r["source_size"] for r in by[s]} == {n}
        assert all(r["target"] == pytest.approx(target) for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - target) <= max(r["size"] for r in by[s]) / 2 + 1e-6
        times = {r["taken"] // r["size"] for r in by[s] if r["size"]}
        assert not times or max(times) - min(times) <= 1


def test_targets_and_whole_documents(docs, rows):
    found = mixture.mix(docs).collect()
    assert len(found) == len(rows)
    check(rows, found)


def test_reruns_and_other_partitions_agree(docs, got):
    assert got(mixture.mix(docs), *COLUMNS) == got(mixture.mix(docs.repartition(7)), *COLUMNS)


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * n, None, s, None) for i, (s, n) in enumerate([("a", 900), ("b", 10), ("c", 10), ("d", 10), (None, 5)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixture.mix(df).collect()
    check(rows, found)
    assert {r["source"]: r["taken"] for r in found}["c"] == 30


def test_better_documents_come_more_often(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("q"),
    )
    found = mixture.mix(df, quality=F.col("q"), weights=(1, 3)).where("source = 'a' AND taken > 0")
    even, odd = (found.where(f"doc_id % 2 = {i}").count() for i in (0, 1))
    # of 2000 documents half are taken; with weights 4 to 1 about 740 to 260
    assert 650 < even < 830 and even + odd == 1000


def test_copies_of_rows(docs, spark, got):
    taken = {r["doc_id"]: r["copies"] for r in mixture.mix(docs).collect()}
    made = defaultdict(int)
    for r in mixture.mixed_documents(docs).collect():
        made[r["doc_id"]] += 1
    assert made == {k: v for k, v in taken.items() if v}


def test_repeated_rows_empty_table_and_clashing_columns(spark, nothing):
    assert mixture.mix(nothing).count() == 0 and mixture.mixed_documents(nothing).count() == 0
    df = spark.createDataFrame([(1, "a b", "s")] * 4 + [(None, None, None)], "doc_id long, text string, source string")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("size", "key", "at", "range", "words", "copies", "target")])
    found = mixture.mix(df).collect()
    assert sum(r["taken"] for r in found) == 8 and len(found) == 5
    assert mixture.mixed_documents(df).columns == df.columns
