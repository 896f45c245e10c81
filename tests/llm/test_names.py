from pyspark.sql import functions as F

import corpus_pipeline
from foliomart.llm import mixture, neardup, packing, repeats
from tests.llm.conftest import WORDS

INTERNAL = ["_row", "_Doc", "_text", "_copies", "_copy", "shift", "at", "range", "node", "block", "line", "host"]


def test_columns_named_like_internal_ones_stay(spark):
    texts = [" ".join(WORDS[i * 70 : i * 70 + 60]) for i in (0, 1, 2)]
    rows = [(1, texts[0], "a"), (2, texts[1], "a"), (3, texts[2], "b"), (4, texts[0], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.select("*", *[F.concat(F.lit("mine "), "doc_id").alias(c) for c in INTERNAL])
    vocabulary = corpus_pipeline.vocabulary_path()
    found = {
        "near": neardup.near_duplicates(df).where("kept"),
        "repeats": repeats.remove_repeats(df),
        "mix": mixture.mixed_documents(df),
        "pack": packing.pack(df, vocabulary),
    }
    for name, result in found.items():
        got = result.select("doc_id", *[F.col(f"`{c}`") for c in INTERNAL]).collect()
        assert got and all(v == f"mine {r[0]}" for r in got for v in r[1:]), name
    assert {r[0] for r in found["near"].select("doc_id").collect()} == {1, 2, 3}
    assert {r[0]: r[1] for r in found["repeats"].select("doc_id", "n_removed").collect()} == {
        1: 0, 2: 0, 3: 0, 4: len(texts[0].encode())}
