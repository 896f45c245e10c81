import random

import pytest
from pyspark.sql import functions as F

from foliomart.llm import exactdup
from tests.llm import brute

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_rows_are_those_of_brute_force(docs, rows, got):
    expected = sorted(brute.op11([(d, t) for d, t, *_ in rows]), key=repr)
    assert got(exactdup.mark(docs), *COLUMNS) == expected
    assert len({r[4] for r in expected}) < len(expected)


@pytest.mark.parametrize("options", [{"slice_docs": 9}, {"hot": 1}, {"hot": 1000}])
def test_slices_and_hot_groups_change_nothing(docs, got, options):
    assert got(exactdup.mark(docs, **options), *COLUMNS) == got(exactdup.mark(docs), *COLUMNS)


def test_large_groups_of_copies(spark, got):
    rnd = random.Random(3)
    rows = [(i, "same  text" + " " * (i % 5)) for i in range(3000)] + [(i, f"own {rnd.random()}") for i in range(3000, 6000)]
    rows += [(i, f"pair {i // 2}") for i in range(6000, 7000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(exactdup.mark(df), *COLUMNS) == sorted(brute.op11(rows), key=repr)


def test_most_rows_go_straight_through(spark):
    rows = stored_rows(spark, 20_000)
    bits = 1 << (20_000 * exactdup.BITS - 1).bit_length()
    marked = exactdup._marked(rows, bits)
    assert marked.where("again AND doc_id >= 0").count() < 0.05 * 20_000
    assert marked.where("again AND doc_id < 0").count() == marked.where("doc_id < 0").count() == 2 * 50


def stored_rows(spark, n):
    ids = spark.range(n).select(F.col("id").alias("doc_id")).unionByName(
        spark.range(100).select((-1 - F.col("id")).alias("doc_id"))
    )
    body = F.when(F.col("doc_id") < 0, F.concat(F.lit("copy"), F.floor(F.col("doc_id") / 2))).otherwise(F.col("doc_id").cast("string"))
    return ids.select(
        "doc_id", F.lit(1).cast("long").alias("n_chars"), F.unhex(F.sha2(body, 256)).alias("digest"),
        F.col("doc_id").alias("row"), F.lit(None).cast("int").alias("carried"),
    )


def test_odd_rows(spark, nothing, got):
    """Nulls, empty texts, repeated rows, null ids and columns named like the operator's own."""
    assert exactdup.mark(nothing).count() == 0 and exactdup.deduplicated(nothing).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "ab "), (None, None), (5, ""), (4, " \n"), (7, "AB"), (8, "a b"), (None, "z"), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(exactdup.mark(df), *COLUMNS) == sorted(brute.op11(rows), key=repr)
    names = ("digest", "row", "carried", "cut", "again", "size", "n_chars", "keep_id", "keep_row", "b0", "m0", "s0", "kept")
    wide = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    kept = exactdup.deduplicated(wide)
    assert kept.columns == wide.columns and kept.schema["text"] == wide.schema["text"]
    assert sorted(map(repr, (r["text"] for r in kept.collect()))) == sorted(map(repr, ["a b", " \n", "AB", "a b", "z"]))


def test_main_path_stays_in_the_jvm(docs):
    plan = exactdup.mark(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
