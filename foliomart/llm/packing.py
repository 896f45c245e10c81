"""Best-fit packing of token sequences, for any number of documents.

A document is its tokens and an end token; a longer one is cut into full pieces and a last one. Best
fit decreasing only looks at lengths, and there are at most ``capacity`` of them. So the pieces are
counted per length, and the plan is made on these counts: lengths go from long to short, a segment
tree over the remaining capacities finds the tightest bins with room, and all pieces of a length that
go to bins of one remaining capacity are placed at once. The plan says which ranks of a length go to
which bins; it is the packing that best fit decreasing makes on the whole corpus, and its size is
bounded by the capacity, not by the documents. Pieces get their rank within their length from counts
per chunk of pieces, then look up sequence and offset.

Null text is an empty document (its end token only). Repeated rows are packed as often as they come.
Columns named like the result's are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from foliomart.llm.texts import Words, encoded, slices
from foliomart.llm.stages import stored, unused

CAPACITY = 2048
END = 0

PIECES = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("rank", T.LongType()),
    ]
)


class Encoder:
    """Token ids of texts, by a byte-pair vocabulary with word ends whose rules drop white space.

    Such a vocabulary gives a text the ids of its white-space-separated words one after another, so a
    word is encoded once and remembered by its hash. A word of Latin letters and a tail of marks has
    the ids of the lower-case letters and then of the tail; letters are encoded many at a time, as a
    word's last token shows where it ends. All other words go through the tokenizer's own rules.
    Up to ``MOST`` words are remembered; beyond that the memory starts anew.
    """

    MOST = 1_500_000
    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.suffix = bool(suffix)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _remember(self, hashes: np.ndarray, ids: list[np.ndarray]) -> None:
        hashes, own = np.unique(hashes, return_index=True)
        ids = [ids[i] for i in own.tolist()]
        at = np.searchsorted(self.hashes, hashes)
        if len(self.hashes):
            new = self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes
            hashes, at, ids = hashes[new], at[new], [x for x, n in zip(ids, new.tolist()) if n]
        if not ids:
            return
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.concatenate(ids)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate((self.store, np.zeros_like(self.store)))
        self.store[self.used : self.used + len(flat)] = flat
        self.hashes = np.insert(self.hashes, at, hashes)
        self.first = np.insert(self.first, at, self.used + np.cumsum(size, dtype=np.int64) - size)
        self.count = np.insert(self.count, at, size)
        self.used += len(flat)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where the words are remembered, -1 if they are not."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def _rules(self, words: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in got]

    def _letters(self, words: list[str]) -> list[np.ndarray]:
        out = []
        for a in range(0, len(words), 2000):
            ids = np.array(self.letters.encode_batch_fast([" ".join(words[a : a + 2000])])[0].ids, np.uint32)
            out += np.split(ids, np.flatnonzero(self.last[ids])[:-1] + 1)
        return out

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        bases, tails, rest, plain = [], [], [], []
        for i, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            match = self.PLAIN.fullmatch(text) if self.suffix else None
            if match:
                plain.append(i)
                bases.append(match[1].lower())
                tails.append(match[2])
            else:
                rest.append(i)
        if rest:
            self._remember(hashes[rest], self._rules([words[i].decode("utf-8", "replace") for i in rest]))
        if plain:
            ends = {t: x for t, x in zip(dict.fromkeys(tails), self._rules(list(dict.fromkeys(tails))))}
            known = Words([x.encode() for x in bases]).hashes
            new = np.flatnonzero(self._places(known) < 0)
            fresh = {bases[i]: i for i in new.tolist()}
            if fresh:
                self._remember(known[list(fresh.values())], self._letters(list(fresh)))
            at = self._places(known)
            first, count = self.first[at].tolist(), self.count[at].tolist()
            ids = [
                np.concatenate((self.store[f : f + c], ends[t])) if t else self.store[f : f + c]
                for f, c, t in zip(first, count, tails)
            ]
            self._remember(hashes[plain], ids)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text with the end token."""
        if len(self.hashes) > self.MOST:
            self._forget()
        words = Words(texts)
        distinct, at, word = np.unique(words.hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(self._places(distinct) < 0)
        if len(new):
            self._learn(words.at(at[new]), distinct[new])
        place = self._places(distinct)[word]
        count = self.count[place].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(count)))
        tokens = self.store[np.repeat(self.first[place] - ends[:-1], count) + np.arange(ends[-1])]
        bounds = ends[words.offsets].tolist()
        return [np.append(tokens[a:b], np.uint32(END)) for a, b in zip(bounds[:-1], bounds[1:])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """``docs`` without the text, a row per piece; ``chunk`` and ``rank`` number pieces of one length."""
    kept = [c for c in docs.columns if c != text and c not in PIECES.names]
    rows = docs.select(
        F.col(text).alias(unused("_text", kept)), *kept, F.monotonically_increasing_id().alias(unused("_row", kept)))
    schema = T.StructType([docs.schema[c] for c in kept] + PIECES.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            texts = encoded(batch.column(0))
            for a, b in slices([len(x) for x in texts], 1 << 21):
                tokens = coder.encode(texts[a:b])
                chunk = batch.column(len(kept) + 1)[a].as_py()
                seen = np.zeros(capacity + 1, np.int64)
                at, number, start, length, crc, body, rank = [], [], [], [], [], [], []
                for i, t in enumerate(tokens):
                    for k, s in enumerate(range(0, len(t), capacity)):
                        raw = t[s : s + capacity].astype("<u4").tobytes()
                        n = len(raw) // 4
                        at.append(a + i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(raw))
                        body.append(raw if ids else None)
                        rank.append(int(seen[n]))
                        seen[n] += 1
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i + 1).take(take) for i in range(len(kept))]
                    + [
                        pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()), pa.array(body, pa.binary()),
                        pa.array([chunk] * len(at), pa.int64()), pa.array(rank, pa.int64()),
                    ],
                    names=[*kept, *PIECES.names],
                )

    return rows.mapInArrow(run, schema)


class Capacities:
    """Segment tree over remaining capacities; leaf r says whether a bin has r left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)

    def set(self, r: int, there: bool) -> None:
        i = r + self.size
        self.tree[i] = there
        while i > 1:
            i >>= 1
            self.tree[i] = self.tree[2 * i] | self.tree[2 * i + 1]

    def tightest(self, least: int) -> int:
        """The smallest remaining capacity of at least ``least``, or -1."""
        i = least + self.size
        if self.tree[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing on counts per length.

    Rows (length, first rank, first bin, pieces per bin, offset): from this rank on, up to the
    length's next row, pieces fill bins one after another from the given offset.
    """
    left: dict[int, list[list[int]]] = {}  # by remaining capacity: ranges of bins [first, count]
    tree, rows, bins = Capacities(capacity), [], 0

    def open_bins(r: int, first: int, count: int) -> None:
        if count and r:
            if not left.get(r):
                left[r] = []
                tree.set(r, True)
            left[r].append([first, count])

    for length in sorted(counts, reverse=True):
        n, rank = counts[length], 0
        while rank < n:
            r = tree.tightest(length)
            if r < 0:
                r = capacity
                each = r // length
                first, count = bins, -(-(n - rank) // each)
                bins += count
            else:
                each = r // length
                first, count = left[r].pop()
                if not left[r]:
                    tree.set(r, False)
            used = min(count, -(-(n - rank) // each))
            rows.append((length, rank, first, each, capacity - r))
            placed = min(n - rank, used * each)
            full, over = divmod(placed, each)
            open_bins(r - each * length, first, full)
            if over:
                open_bins(r - over * length, first + full, 1)
            if used < count:
                open_bins(r, first + used, count - used)
            rank += placed
    return rows


def pack(
    docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY, ids: bool = False
) -> DataFrame:
    """The pieces of all documents with sequence_id and offset; ``ids`` adds the tokens (little endian)."""
    spark = docs.sparkSession
    docs = docs.select([c for c in docs.columns if c not in ("sequence_id", "offset", "n")])
    cut = stored(pieces(docs, vocabulary, text, capacity, ids), "pieces")
    held = stored(
        cut.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most `capacity` rows
    counts = {r[0]: r[1] for r in held.groupBy("length").agg(F.sum("n")).collect()}
    rows = plan(counts, capacity)
    at = {}
    for length, rank, first, each, offset in rows:
        at.setdefault(length, []).append((rank, first, each, offset))
    shared = spark.sparkContext.broadcast({k: np.array(v, np.int64).T.copy() for k, v in at.items()})
    before = F.sum("n").over(W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))
    more = unused("shift", cut.columns)
    shift = held.select("chunk", "length", F.coalesce(before, F.lit(0)).alias(more))
    ranked = cut.join(shift, ["chunk", "length"]).withColumn("rank", F.col("rank") + F.col(more)).drop(more, "chunk")
    names = [c for c in cut.columns if c not in ("chunk", "rank")]
    ranked = ranked.select(*names, "rank")
    schema = T.StructType(
        [cut.schema[c] for c in names] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        for batch in batches:
            length = np.asarray(batch.column(names.index("length")), np.int64)
            rank = np.asarray(batch.column(len(names)), np.int64)
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                n = int(length[own[0]])
                first_rank, first, each, begin = by[n]
                i = np.searchsorted(first_rank, rank[own], "right") - 1
                inside = rank[own] - first_rank[i]
                sequence[own] = first[i] + inside // each[i]
                offset[own] = begin[i] + inside % each[i] * n
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + [pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    out = ranked.mapInArrow(run, schema)
    return out if ids else out.drop("ids")
