import shutil

import pytest
from pyspark.sql import functions as F

from foliomart.llm import tokencounts as tc

FACT = "source string, lang string, tokenizer string, tokens long, sign long"


@pytest.fixture
def rollup(spark, tmp_path):
    return tc.Rollup(spark, f"file://{tmp_path}/rollup")


def state(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=repr)


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def test_inserts_deletes_and_revisions(spark, rollup):
    old = facts(spark, ("a", "en", "v1", 5, 1), ("a", "en", "v1", 7, 1), (None, None, "v1", None, None))
    assert rollup.commit("1", old)
    assert state(rollup) == [("a", "en", "v1", 2, 12), (None, None, "v1", 1, 0)]
    assert rollup.commit("2", tc.deletes(facts(spark, ("a", "en", "v1", 5, 1))))
    assert rollup.commit("3", tc.revised(facts(spark, ("a", "en", "v1", 7, 1)), facts(spark, ("a", "en", "v2", 9, 1))))
    assert state(rollup) == [("a", "en", "v2", 1, 9), (None, None, "v1", 1, 0)]


def test_commits_are_idempotent_and_order_does_not_matter(spark, tmp_path):
    batches = {"a": facts(spark, ("s", "en", "v", 5, 1)), "b": facts(spark, ("s", "en", "v", 5, -1), ("s", "de", "v", 2, 1)), "c": facts(spark)}
    seen = []
    for k, order in enumerate(["abc", "cba", "babcab"]):
        r = tc.Rollup(spark, f"file://{tmp_path}/{k}")
        assert [r.commit(n, batches[n]) for n in order].count(True) == 3
        assert r.batches() == ["a", "b", "c"]
        seen.append(state(r))
    assert seen == [[("s", "de", "v", 1, 2)]] * 3


def test_a_batch_that_was_cut_off_is_written_anew(spark, rollup, tmp_path):
    rollup.commit("1", facts(spark, ("a", "en", "v", 5, 1)))
    (tmp_path / "rollup" / "batch=1" / "_SUCCESS").unlink()
    assert rollup.batches() == [] and state(rollup) == []
    assert rollup.commit("1", facts(spark, ("a", "en", "v", 6, 1)))
    assert state(rollup) == [("a", "en", "v", 1, 6)]


def test_compaction_keeps_totals_and_names(spark, rollup, tmp_path):
    for i in range(4):
        rollup.commit(f"b{i}", facts(spark, ("a", "en", "v", i, 1)))
        if i % 2:
            rollup.compact()
    rollup.commit("last", facts(spark, ("a", "en", "v", 100, 1)))
    assert state(rollup) == [("a", "en", "v", 5, 106)]
    assert not rollup.commit("b0", facts(spark, ("a", "en", "v", 7, 1)))
    # the folders of compacted batches are not needed any more
    shutil.rmtree(tmp_path / "rollup" / "batch=b0")
    assert state(rollup) == [("a", "en", "v", 5, 106)] and not rollup.commit("b0", facts(spark))


def test_documents(spark, docs, rows, tmp_path, nothing):
    made = {tuple(r)[:3]: tuple(r)[3:] for r in tc.maintained(docs, f"file://{tmp_path}/docs").totals().collect()}
    distinct = {(s, lang, t or "") for _, t, lang, s, _ in rows}
    for s, lang in {d[:2] for d in distinct}:
        own = [t for a, b, t in distinct if (a, b) == (s, lang)]
        assert made[s, lang, "words-2"][0] == len(own)
    assert {k[2] for k in made} == {"words-2"}
    assert tc.maintained(nothing, f"file://{tmp_path}/none").totals().count() == 0


def test_names_are_checked(spark, rollup):
    with pytest.raises(ValueError):
        rollup.commit("../x", facts(spark))


def test_extra_columns_do_not_matter(spark, rollup):
    df = facts(spark, ("a", "en", "v", 5, 1)).withColumn("n_docs", F.lit(9)).withColumn("n_tokens", F.lit(9))
    rollup.commit("1", df)
    assert state(rollup) == [("a", "en", "v", 1, 5)]
