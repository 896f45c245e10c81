import random
import time
import tracemalloc

import numpy as np
import pytest

from foliomart.llm import neardup
from foliomart.llm.components import components
from foliomart.llm.texts import shingles, word_hashes
from tests.llm import brute
from tests.llm.conftest import prose

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def test_against_brute_force(docs, rows, got):
    for words in (4, 5):
        found = neardup.near_duplicates(docs, words=words)
        assert got(found, *COLUMNS) == sorted(brute.op9([(r[0], r[1]) for r in rows], words), key=repr)


def edited(rnd, text, share):
    w = text.split(" ")
    for i in range(len(w)):
        if rnd.random() < share:
            w[i] = f"new{rnd.randrange(10**6)}"
    return " ".join(w)


def test_a_group_of_edited_copies(spark, got, monkeypatch):
    """Copies of one text with few and many edits, in parts smaller than the group."""
    monkeypatch.setattr(neardup, "PART_ROWS", 25)
    rnd = random.Random(5)
    origin = prose(rnd, 160)
    texts = [origin] + [edited(rnd, origin, rnd.choice([0.005, 0.02, 0.04, 0.06])) for _ in range(120)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(neardup.near_duplicates(df, words=4), *COLUMNS) == sorted(brute.op9(rows), key=repr)


def test_links_inside_connect_what_pairs_connect():
    rnd = random.Random(7)
    texts = [prose(rnd, 80)]
    for _ in range(30):
        texts.append(edited(rnd, rnd.choice(texts), 0.02))
    words, off = word_hashes([t.encode() for t in texts])
    sets = [shingles(words[off[i] : off[i + 1]], 4) for i in range(len(texts))]
    sigs = np.stack([neardup.signature(s) for s in sets])
    links, _ = neardup.links_inside(list(range(len(texts))), sets, sigs, 0, 80)
    assert len(links) < len(texts)
    root = list(range(len(texts)))
    for a, b in links:
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    for a in range(len(texts)):
        for b in range(a):
            if neardup.jaccard_at_least(sets[a], sets[b], 80):
                assert root[a] == root[b]


def test_lists_count_what_sets_share(monkeypatch):
    """Short and long lists, lists of the same members, more long lists than a chunk holds."""
    monkeypatch.setattr(neardup.Lists, "CELLS", 400)
    rnd = np.random.default_rng(3)
    template = np.arange(10**6, 10**6 + 300)
    sets = [np.unique(np.r_[rnd.integers(0, 900, 200), template[: 300 - i % 4]]).astype(np.uint64) for i in range(150)]
    rows = np.array([3, 0, 77, 149])
    assert neardup.Lists(sets).overlaps(rows).tolist() == [[len(np.intersect1d(sets[i], x)) for x in sets] for i in rows]
    assert neardup.Lists([sets[0][:0], sets[0]]).overlaps(np.array([0, 1])).tolist() == [[0, 0], [0, 0]]


def test_pairs_of_long_texts_are_counted_some_at_a_time(monkeypatch):
    """100 texts of 4,000 shingles, each held by about 40 of them: 16 million pairs of a text and a holder."""
    monkeypatch.setattr(neardup.Lists, "CELLS", 1 << 18)
    rnd = np.random.default_rng(1)
    pool = rnd.integers(1, 2**63, 10_000).astype(np.uint64)
    sets = [np.sort(rnd.choice(pool, 4000, replace=False)) for _ in range(100)]
    lists = neardup.Lists(sets)
    tracemalloc.start()
    got = lists.overlaps(np.arange(100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # before: 400 MB and more
    assert [got[i, j] for i, j in ((0, 0), (0, 1), (98, 3))] == [4000, len(np.intersect1d(sets[0], sets[1])), len(np.intersect1d(sets[98], sets[3]))]


def test_long_texts_share_no_values_by_chance():
    rnd = np.random.default_rng(2)
    sigs = np.stack([neardup.signature(rnd.integers(1, 2**63, 2000).astype(np.uint64)) for _ in range(1500)])
    assert all(len(np.unique(sigs[:, i])) == 1500 for i in range(neardup.M))


def test_pages_of_one_template_are_compared_at_once():
    """1,500 pages at 0.65 (candidates that do not link), and pairs of near copies among them."""
    rnd = random.Random(12)
    template = prose(rnd, 190)
    texts = [f"{template} {' '.join(f'own{rnd.randrange(10**9)}' for _ in range(50))}" for _ in range(1500)]
    for i in range(100, 1500, 100):
        texts[i] = edited(rnd, texts[i - 1], 0.01)
    words, off = word_hashes([t.encode() for t in texts])
    sets = [shingles(words[off[i] : off[i + 1]], 4) for i in range(len(texts))]
    sigs = np.stack([neardup.signature(s) for s in sets])
    begin = time.process_time()
    links, _ = neardup.links_inside(list(range(1500)), sets, sigs, 0, 80)
    assert time.process_time() - begin < 8
    want = {(i - 1, i) for i in range(100, 1500, 100) if neardup.jaccard_at_least(sets[i - 1], sets[i], 80)}
    assert want and {tuple(sorted(x)) for x in links} == want


def test_nulls_and_extra_columns(spark, got):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (6, "A b  c\td e"), (8, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node int, kept int")
    found = neardup.near_duplicates(df, words=4)
    assert found.columns == ["doc_id", "text", "node", "n_shingles", "component_id", "kept"]
    assert got(found, "doc_id", "component_id", "kept") == sorted(
        [(None, None, True), (4, 4, True), (4, 4, True), (6, 4, False), (8, 8, True)], key=repr
    )


def test_empty_table(nothing):
    assert neardup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_a_path_and_a_star(spark, n):
    links = [(i, i + 1) for i in range(100, 100 + n)] + [(7, 1000 + i) for i in range(n)] + [(3, 3)]
    made = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {made[i] for i in range(100, 101 + n)} == {100}
    assert {made[7], made[1000], made[999 + n]} == {7} and made[3] == 3


def test_components_of_long_paths_in_any_order(spark):
    """A path through 2,000 shuffled ids, one through falling ids, and both ends of the order joined late."""
    ids = list(range(2000))
    random.Random(3).shuffle(ids)
    links = list(zip(ids, ids[1:])) + [(9000 - i, 8999 - i) for i in range(400)] + [(5000, 9500)]
    zigzag = [6000, *[x for i in range(150) for x in (6999 - i, 6001 + i)]]
    links += list(zip(zigzag, zigzag[1:]))
    made = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {made[i] for i in ids} == {0} and {made[i] for i in range(8600, 9001)} == {8600}
    assert {made[i] for i in zigzag} == {6000} and made[9500] == 5000 and len(made) == 2000 + 401 + 2 + 301
