from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from foliomart.llm.entries import vocabulary_path
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS, corpus
from tests.llm.test_packing import gapless


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and gave, written and read again in between."""
    folder = tmp_path_factory.mktemp("stages")
    spark.createDataFrame(corpus(5, 90), DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    docs, made = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{k}")
        out = spark.read.parquet(f"{folder}/{k}")
        made[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    return made, str(folder)


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_keep_the_columns(steps):
    for name, (_, _, columns) in list(steps[0].items())[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_quality(steps):
    given, got, _ = steps[0]["quality rules"]
    verdict = brute.op5_verdict([(r["doc_id"], r["text"], r["source"]) for r in given])
    assert texts(got) == {d: t for d, (kept, t) in verdict.items() if kept}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert len(got) < len(given)


def test_near_duplicates(steps):
    given, got, _ = steps[0]["near duplicates"]
    kept = {d for d, _, _, k in brute.op9([(r["doc_id"], r["text"]) for r in given], 5) if k}
    assert texts(got) == {d: t for d, t in texts(given).items() if d in kept} and len(got) < len(given)


def test_repeats(steps):
    given, got, _ = steps[0]["repeated passages"]
    left = brute.cut_repeats([(r["doc_id"], r["text"]) for r in given])
    assert texts(got) == {d: t for d, t in left.items() if t != "" or not dict(texts(given))[d]}
    assert any(t != texts(given)[d] for d, t in left.items())


def test_mixture(steps):
    given, got, _ = steps[0]["source mixture"]
    by, n = defaultdict(list), Counter(r["doc_id"] for r in got)
    for r in given:
        by[r["source"]].append((r["doc_id"], len(brute.words(r["text"]))))
    order = sorted(by, key=lambda s: (s is None, s))
    for s, target in zip(order, brute.targets([sum(w for _, w in by[s]) for s in order])):
        assert abs(sum(n[d] * w for d, w in by[s]) - target) <= max(w for _, w in by[s]) / 2 + 1e-6
    assert all(texts(given)[d] == t for d, t in texts(got).items())


def test_packing(steps):
    given, got, _ = steps[0]["packed sequences"]
    want = brute.op10([(r["doc_id"], r["text"]) for r in given], vocabulary_path())
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert gapless(used.values(), 2048)
    assert len(used) == brute.best_fit_decreasing([r["length"] for r in got], 2048)


def test_run_gives_what_the_stages_give(spark, steps):
    made = corpus_pipeline.run(spark, steps[1])
    cut = ["doc_id", "piece", "length", "ids_crc32"]
    assert Counter(tuple(r[c] for c in cut) for r in made.collect()) == Counter(tuple(r[c] for c in cut) for r in steps[0]["packed sequences"][1])
