import random
from collections import defaultdict

import pytest

from foliomart.llm import packing
from foliomart.llm.entries import vocabulary_path
from tests.llm import brute

CUT = ["doc_id", "piece", "start", "length", "ids_crc32"]


@pytest.mark.parametrize("capacity", [7, 16, 50])
def test_plan_is_best_fit_decreasing(capacity):
    rnd = random.Random(capacity)
    for _ in range(60):
        counts = {n: rnd.randint(1, 30) for n in rnd.sample(range(1, capacity + 1), rnd.randint(1, capacity))}
        rows, used = packing.plan(counts, capacity), defaultdict(list)
        for k, (n, rank, first, each, offset) in enumerate(rows):
            end = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == n else counts[n]
            for x in range(rank, end):
                used[first + (x - rank) // each].append((offset + (x - rank) % each * n, n))
        assert gapless(used.values(), capacity)
        assert len(used) == brute.best_fit_decreasing([n for n, c in counts.items() for _ in range(c)], capacity)


def gapless(sequences, capacity):
    for pieces in sequences:
        at = 0
        for offset, n in sorted(pieces):
            if offset != at:
                return False
            at += n
        if at > capacity:
            return False
    return True


def test_pieces_and_places(docs, rows, got):
    found = packing.pack(docs, vocabulary_path()).cache()
    assert got(found, *CUT) == sorted(brute.op10([(r[0], r[1]) for r in rows], vocabulary_path()), key=repr)
    used = defaultdict(list)
    for r in found.collect():
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert gapless(used.values(), 2048)
    assert len(used) == brute.best_fit_decreasing([n for v in used.values() for _, n in v], 2048)


def test_tokens_come_along_and_small_capacity(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven"), (1, "one"), (None, None)], "doc_id long, text string")
    df = df.selectExpr("*", "1 AS chunk", "'x' AS rank", "2 AS offset")
    found = packing.pack(df, vocabulary_path(), capacity=4, ids=True).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in found)
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in found) == [(0, 0, 1), (1, 0, 2), (1, 0, 4), (1, 1, 4)]


def test_words_have_the_tokenizers_ids():
    coder = packing.Encoder(vocabulary_path())
    odd = [
        "<|startoftext|> a", "a<|endoftext|>b c", "Σας ΟΔΟΣ", "é ́x e", "a\x0bb\x1cc d　e", "", "  ", "\x85 a",
        "don't I'll x's. 's 'll.x a.b--- ABC'S Été!!! İx ªº µ×÷ ſ K ¼ ǅ ß", "É.. n̈", "1a2 a1. 12,3", "café,,, CAFÉ;",
    ]
    for _ in range(2):  # new words, then known ones
        for text, ids in zip(odd, coder.encode([x.encode() for x in odd])):
            assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_forgetting_changes_nothing(monkeypatch):
    coder = packing.Encoder(vocabulary_path())
    first = [x.tolist() for x in coder.encode([b"one two", b"three One two."])]
    monkeypatch.setattr(packing.Encoder, "MOST", 1)
    assert [x.tolist() for x in coder.encode([b"one two", b"three One two."])] == first


def test_empty_table(nothing):
    assert packing.pack(nothing, vocabulary_path()).count() == 0
