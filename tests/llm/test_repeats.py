import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliomart.llm import exchange, repeats
from tests.llm import brute

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def texts_of(rnd, most=12):
    return [bytes(rnd.choice(b"ab\0\xff") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, most))]


def test_index_orders_suffixes_and_finds_longest_matches():
    rnd = random.Random(3)
    for _ in range(25):
        texts = texts_of(rnd)
        index = repeats.MatchIndex(texts)
        begin = np.concatenate(([0], index.ends[:-1] + 1))
        plain = sorted(
            ((t[i:], k, i) for k, t in enumerate(texts) for i in range(len(t) + 1)), key=lambda s: ([c + 1 for c in s[0]], s[1])
        )
        assert index.order.tolist() == [int(begin[k] + i) for _, k, i in plain]
        assert (np.diff(index.run_symbol) != 0).all()
        assert (index.head == index.order[index.run_start]).all()
        pattern = bytes(rnd.choice(b"ab\0\xffc") for _ in range(25))
        whole = b"".join(t + b"\x01" for t in texts)
        for i, (size, at) in enumerate(index.statistics(pattern)):
            assert size == max(n for n in range(26 - i) if any(pattern[i : i + n] in t for t in texts))
            assert not size or whole[at : at + size] == pattern[i : i + size]


@pytest.mark.parametrize("length", [1, 2, 3, 5, 8])
def test_owner_of_every_window(length):
    rnd = random.Random(length)
    for _ in range(20):
        texts = texts_of(rnd)
        docs = np.array([rnd.randint(0, 9) for _ in texts])
        for t, own in zip(texts, repeats.owners(texts, docs, length)):
            for i in range(len(t) - length + 1):
                assert own[i] == min(d for d, u in zip(docs, texts) if t[i : i + length] in u)


def test_runs_cover_every_window_and_depend_on_content_only():
    rnd = random.Random(8)
    texts = [bytes(rnd.choice(b"abcdef gh") for _ in range(n)) for n in (0, 49, 50, 51, 400, 3000)] + [b"q" * 300]
    texts.append(b"##" + texts[4][:200] + b"!!")
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    raw = b"".join(texts)
    start, until, doc, key = repeats.runs(np.frombuffer(raw, np.uint8), begins, ends, chunk=256)
    assert ((until - start) <= repeats.RUN).all()
    covered = sorted(p for a, b in zip(start, until) for p in range(a, b))
    assert covered == [p for a, b in zip(begins, ends) for p in range(a, b - 49)]
    by_window = {}
    for a, b, k in zip(start, until, key):
        for p in range(a, b):
            assert by_window.setdefault(raw[p : p + 50], k) == k


def test_against_brute_force(docs, rows, got):
    found = repeats.remove_repeats(docs, texts=False)
    assert got(found, *COLUMNS) == sorted(brute.op2([(r[0], r[1]) for r in rows]), key=repr)


@pytest.mark.parametrize("setting", [("HOT", 2), ("BLOCK", 500)])
def test_splitting_changes_nothing(docs, rows, got, monkeypatch, setting):
    """Keys split by windows, and small blocks, give the same result."""
    monkeypatch.setattr(repeats, *setting)
    found = repeats.remove_repeats(docs, texts=False)
    assert got(found, *COLUMNS) == sorted(brute.op2([(r[0], r[1]) for r in rows]), key=repr)


def test_index_batches_change_nothing(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(2)
    base = bytes(rnd.choice(b"abc") for _ in range(900))
    made = [base[i * 40 : i * 40 + 200] + bytes(rnd.choice(b"abc") for _ in range(60)) for i in range(15)]
    ends = np.cumsum([len(t) for t in made])
    raw = b"".join(made)
    start, until, doc, keys = repeats.runs(np.frombuffer(raw, np.uint8), ends - [len(t) for t in made], ends)
    texts = [raw[x : y + 49] for x, y in zip(start.tolist(), until.tolist())]
    docs = 100 - doc
    (_, block, n, body), = repeats._sent(4, 1, np.zeros(len(texts), np.int64), keys, docs, texts)
    table = pa.table({"block": [block], "n": [n], "body": [body]})
    whole = repeats._settled(table, 50)
    monkeypatch.setattr(repeats, "BUCKET", 100)
    assert repeats._settled(table, 50) == whole


def test_ties_nulls_repeated_rows_and_columns(spark, got):
    text = "the same fifty bytes and some more of them, again and again in every text here"
    rows = [(5, text), (5, text), (5, "own " + text), (9, text), (None, text), (None, "x" + text), (7, None)]
    df = spark.createDataFrame([(a, b, "k") for a, b in rows], "doc_id long, text string, block string").withColumn("n_bytes", F.lit("z"))
    found = repeats.remove_repeats(df)
    assert set(found.columns) >= {"doc_id", "text", "block"}
    n = len(text)
    assert got(found, "doc_id", "n_bytes", "n_removed") == sorted(
        [(5, n, 0), (5, n, 0), (5, n + 4, 0), (9, n, n), (None, n, n), (None, n + 1, n), (7, 0, 0)], key=repr
    )


def test_cut_texts_stay_whole_characters(spark, got):
    a = "ü" * 30 + "the rest is something else entirely, to be kept"
    df = spark.createDataFrame([(1, "x" + "ü" * 30), (2, a), (3, "x" + "ü" * 30)], "doc_id long, text string")
    left = dict(got(repeats.without_repeats(df), "doc_id", "text"))
    assert left[1] == "x" + "ü" * 30 and 3 not in left
    assert left[2].endswith("the rest is something else entirely, to be kept")


def test_empty_table(nothing):
    assert repeats.remove_repeats(nothing).count() == 0


def test_keys_are_counted_over_blocks(spark):
    keys = {0: [1, 5, 2**40], 1: [5, 2**63], 2: [5, 1]}
    blocks = spark.createDataFrame(
        [(b, np.array(k, np.uint64).tobytes()) for b, k in keys.items()], "block long, payload binary"
    )

    def keys_of(payload):
        k = np.frombuffer(payload, np.uint64)
        return k, np.ones(len(k), np.int64)

    answers = exchange.answer(exchange.ask(blocks, keys_of, 5)).toArrow()
    for b, k in keys.items():
        own = answers.filter([x == b for x in answers["block"].to_pylist()])
        assert exchange.answered(own, np.array(k, np.uint64), 5).tolist() == [sum(x in v for v in keys.values()) for x in k]


def logs():
    """Two long texts of one row template, each piece of it different, and a passage that both hold."""
    rnd = random.Random(12)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    rows = [[f"host=frontend service=catalogue status=ok time={rnd.randrange(10**9):09d}{rnd.randrange(10**9):09d} id={rnd.randrange(10**9):09d}"
             for _ in range(15000)] for _ in range(2)]
    rows[1][7000:7003] = rows[0][300:303]
    return ["\n".join([*r[:9000], passage, *r[9000:]]) for r in rows]


def test_a_key_weighs_what_it_holds(spark):
    """In blocks of one document each, a key is counted by its different pieces."""
    df = spark.createDataFrame(list(enumerate(logs())), "doc_id long, text string")
    blocks = repeats.pack(df, "doc_id", "text", 50).cache()
    assert blocks.count() == 2
    answers = exchange.answer(exchange.ask(blocks, repeats._keys_of(50), 3), flagged=True).toArrow()
    for block, payload in [(r["block"], bytes(r["payload"])) for r in blocks.collect()]:
        b = repeats.Block(pa.py_buffer(payload))
        start, until, doc, key = b.runs(50)
        found, counts = np.unique(key, return_counts=True)
        told = exchange.answered(answers.filter([x == block for x in answers["block"].to_pylist()]), found, 3)
        top = int(counts.argmax())
        pieces = {b.raw[x : y + 49] for x, y in zip(start[key == found[top]].tolist(), until[key == found[top]].tolist())}
        assert len(pieces) > 10000 and told[top] >= len(pieces) and (told[counts == 1] == 0).any()


def test_long_texts_of_one_template(spark, got):
    """More pieces under a key than an index holds: its windows are told apart one by one."""
    texts = logs()
    found = repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts=False)
    assert got(found, *COLUMNS) == sorted(brute.op2(list(enumerate(texts))), key=repr)
