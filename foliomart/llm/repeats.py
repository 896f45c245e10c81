"""Passages that recur across documents, found with a run-compressed Burrows-Wheeler index.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller
doc_id is marked. Strings are judged on the input; matches never cross documents.

1. **Blocks.** Documents are packed into compressed blocks and written once. Of equal texts only the
   one with the smallest doc_id goes on; the others are covered as a whole.
2. **Anchors.** Every window of ``length`` bytes is keyed by its smallest ``GRAM``-byte hash, so equal
   windows have equal keys. `exchange` tells each block which of its keys occur in another document.
3. **Pieces.** The windows of one key in a row form a piece (the bytes they cover, at most
   ``length + RUN - 1``). Equal pieces of a block are one, with its smallest doc_id. Pieces of shared
   keys go to buckets by key; a key above ``HOT`` pieces is split by whole windows.
4. **Index.** A bucket's distinct pieces become one text. Its Burrows-Wheeler transform is kept as
   runs with text positions sampled at run ends. Rows whose suffixes share ``length`` bytes are one
   class, tagged with the smallest doc_id that holds it. Each piece is streamed backwards through the
   runs; where its matching statistic reaches ``length``, the class of the row tells who owns the
   window. A piece that is alone under its key is its own owner and needs no index.
5. **Marks.** Blocks get back one bit per window and take the union of the covered bytes.

Null text is empty. Null doc_id counts as larger than any other. Rows with equal doc_id do not mark
each other. Texts shorter than ``length`` are left alone. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.llm import exchange
from foliomart.llm.texts import encoded, mixed, slices
from foliomart.llm.stages import dropped, stored, unused

LENGTH = 50
GRAM = 20
RUN = 30
HOT = 8192
BLOCK = 1 << 20
BUCKET = 400_000
_NONE = np.int64(2**63 - 1)
_BYTE = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_STEP, _LAST = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


# anchors

def _gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """32-bit hash of the n bytes from each place: halves are combined, the odd rest by overlapping."""
    h, size = _BYTE[data], 1
    while size < n:
        by = min(size, n - size)
        left = h[:-by] * _STEP
        left ^= left >> np.uint32(15)
        left += h[by:]
        h, size = left, size + by
    h *= _LAST
    h ^= h >> np.uint32(16)
    return h


def _slid_min(h: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size < w:
        by = min(size, w - size)
        h, size = np.minimum(h[:-by], h[by:]), size + by
    return h


def _gram_keys(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """64-bit keys of the n bytes at the given places."""
    words = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,))
    key = np.full(len(at), n, np.uint64)
    for i in [*range(0, n - 7, 8), n - 8]:
        key = mixed(key ^ words[at + i]) + key
    return mixed(key)


def runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int = LENGTH, chunk: int = 1 << 15):
    """Runs of window starts with one key: first start, end, document's place, key."""
    none = np.zeros(0, np.int64)
    long = np.flatnonzero(ends - begins >= length)
    if not len(long):
        return none, none, none, np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    wide = length - GRAM + 1
    starts, anchors = [], []
    for a in range(0, len(data) - length + 1, chunk):
        h = _gram_hashes(data[a : a + chunk + length - 1], GRAM)
        least = _slid_min(h, wide)
        at = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        inside = np.lib.stride_tricks.as_strided(h, (len(least), wide), (4, 4))[at] == least[at, None]
        starts.append(at + a)
        anchors.append(at + inside.argmax(axis=1) + a)
    starts, anchors = np.concatenate(starts), np.concatenate(anchors)
    values = _gram_keys(data, anchors, GRAM)
    place = np.searchsorted(starts, begins[long], "right")
    more = starts[place - 1] != begins[long]  # a document begins inside a run
    cuts = np.insert(starts, place[more], begins[long][more])
    values = np.insert(values, place[more], values[place[more] - 1])
    held = np.diff(np.append(np.searchsorted(cuts, begins), len(cuts)))
    doc = np.repeat(np.arange(len(begins)), held)
    until = np.minimum(np.append(cuts[1:], len(data)), ends[doc] - length + 1)
    ok = until > cuts
    cuts, until, doc, values = cuts[ok], until[ok], doc[ok], values[ok]
    count = -(-(until - cuts) // RUN)
    if (count > 1).any():
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        last = np.repeat(until, count)
        cuts, doc, values = np.repeat(cuts, count) + step * RUN, np.repeat(doc, count), np.repeat(values, count)
        until = np.minimum(cuts + RUN, last)
    return cuts, until, doc, values


# blocks

class Block:
    """The decoded payload: an Arrow table, its texts as one buffer, documents' ranges and ids."""

    def __init__(self, payload):
        self.table = pa.ipc.open_stream(payload).read_all()
        texts = encoded(self.table.column(1).combine_chunks())
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        ids = self.table.column(0).combine_chunks()
        self.ids = np.asarray(ids.fill_null(int(_NONE)), np.int64)

    def runs(self, length: int):
        return runs(self.data, self.begins, self.ends, length)


def pack(docs: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    """Blocks of documents with all their columns; the first two are the id and the text to work on."""
    names = docs.columns
    others = [c for c in names if c not in (doc_id, text)]
    rest = docs.select(
        F.col(doc_id).cast("long").alias(unused("_doc", others)), F.col(text).alias(unused("_text", others)), *others
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in slices([s + 16 for s in sizes], BLOCK):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(a, b - a))
                ids = batch.column(0).slice(a, b - a).fill_null(int(_NONE)).to_pylist()
                raw = encoded(batch.column(1).slice(a, b - a))
                texts = [
                    {"place": i, "doc": d, "digest": hashlib.blake2b(t, digest_size=16).digest()}
                    for i, (d, t) in enumerate(zip(ids, raw)) if len(t) >= length
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([sum(sizes[a:b])], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                        pa.array([texts], _TEXTS),
                    ],
                    names=["n_bytes", "payload", "texts"],
                )

    return exchange.numbered(
        rest.mapInArrow(run, "n_bytes long, payload binary, texts array<struct<place: int, doc: long, digest: binary>>")
    )


_TEXTS = pa.list_(pa.struct([("place", pa.int32()), ("doc", pa.int64()), ("digest", pa.binary())]))


def copies(blocks: DataFrame) -> DataFrame:
    """Per block the places of documents whose whole text a smaller doc_id holds.

    Copies are counted by digest with map-side sums, and only digests held twice are joined.
    """
    seen = blocks.select("block", F.inline("texts"))
    held = seen.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    held = stored(held.select("digest", "first"), "copied")
    later = seen.join(held, "digest").where("doc > first")
    places = stored(later.groupBy("block").agg(F.array_sort(F.collect_list("place")).alias("places")), "copies")
    dropped(held)
    return places


def _keys_of(length: int):
    def keys(payload):
        block = Block(payload)
        start, until, doc, key = block.runs(length)
        found, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        ids = block.ids[doc]
        low, high = np.full(len(found), _NONE), np.full(len(found), -_NONE)
        np.minimum.at(low, back, ids)
        np.maximum.at(high, back, ids)
        # the weight is the number of different pieces; two documents of this block are enough to share a key
        many = np.flatnonzero(counts[back] > 1)
        if len(many):
            a, b = start[many], until[many]
            piece = _gram_keys(block.data, a, length) ^ mixed(_gram_keys(block.data, b - 1, length) + (b - a).astype(np.uint64))
            distinct = np.unique(mixed(piece) ^ key[many], return_index=True)[1]
            held = np.bincount(back[many][distinct], minlength=len(found))
            counts = np.where(counts > 1, held, counts)
        weights = np.minimum(counts, exchange.SHARED - 1).astype(np.uint16)
        weights[low < high] |= exchange.SHARED
        return found, weights

    return keys


# pieces

def _sent(block: int, n: int, where: np.ndarray, key: np.ndarray, doc: np.ndarray, texts: list[bytes]) -> list[tuple]:
    """A row per bucket: piece numbers, keys, doc_ids, lengths and bytes of its pieces."""
    rows = []
    order = np.argsort(where, kind="stable")
    ends = np.searchsorted(where[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(ends)).tolist():
        at = order[ends[b] : ends[b + 1]]
        own = [texts[i] for i in at.tolist()]
        size = np.fromiter(map(len, own), np.uint8, len(own))
        steps = np.diff(at, prepend=0).astype(np.uint32)
        body = exchange.packed(steps, key[at].astype(np.uint32), doc[at], size, *own)
        rows.append((b, block, len(at), body))
    return rows


def _received(n: int, body: bytes):
    """Piece steps as sent, keys (by their low halves: a bucket is a range of the high ones), doc_ids, texts."""
    raw = exchange.unpacked(body)
    key = np.frombuffer(raw, np.uint32, n, 4 * n)
    doc = np.frombuffer(raw, np.int64, n, 8 * n)
    size = np.frombuffer(raw, np.uint8, n, 16 * n).astype(np.int64)
    ends = 17 * n + np.cumsum(size)
    texts = [raw[e - s : e] for s, e in zip(size.tolist(), ends.tolist())]
    return raw[: 4 * n], key, doc, texts


def _pieces(blocks: DataFrame, answers: DataFrame, n_keys: int, n: int, length: int) -> DataFrame:
    """Rows to buckets (bucket >= 0) and, per block, where its pieces stand (bucket -1)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for number, payload in zip(left["block"].to_pylist(), left["payload"]):
            block = Block(payload.as_buffer())
            start, until, doc, key = block.runs(length)
            found, back = np.unique(key, return_inverse=True)
            copied = [p for places in right["places"].to_pylist() for p in places or ()]
            counts = right.filter(pc.is_valid(right["counts"]))
            held = exchange.answered(counts, found, n_keys)[back]
            shared = np.flatnonzero((held > 0) & ~np.isin(doc, copied))
            hot = held[shared] >= HOT
            place: dict[tuple[int, bytes], int] = {}
            own: list[int] = []
            at, piece = [], []
            ids = block.ids
            for i, is_hot in zip(shared.tolist(), hot.tolist()):
                a, b, d, k = int(start[i]), int(until[i]), int(doc[i]), int(key[i])
                cuts = [(a, b)] if not is_hot else [(x, x + 1) for x in range(a, b)]
                for x, y in cuts:
                    part = block.raw[x : y + length - 1]
                    at_key = (k if not is_hot else xxhash.xxh3_64_intdigest(part, k), part)
                    p = place.setdefault(at_key, len(own))
                    if p == len(own):
                        own.append(int(ids[d]))
                    elif ids[d] < own[p]:
                        own[p] = int(ids[d])
                    at.append(x)
                    piece.append(p)
            keys = np.fromiter((k for k, _ in place), np.uint64, len(place))
            where = (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
            texts = [t for _, t in place]
            out += _sent(number, n, where, keys, np.array(own, np.int64), texts)
            width = np.array([len(t) - length + 1 for t in texts], np.uint8)
            steps = [np.diff(np.array(x, np.int64), prepend=0).astype(np.int32) for x in (at, piece)]
            plan = exchange.packed(np.array([len(at), len(texts)], np.int64), *steps, width, np.array(copied, np.int32))
            out.append((-1, number, len(at), plan))
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
            names=["bucket", "block", "n", "body"],
        )

    return blocks.select("block", "payload").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "bucket int, block long, n long, body binary"
    )


# index

class MatchIndex:
    """Run-length Burrows-Wheeler index of several texts with text positions at run ends.

    Symbols are bytes + 1; 0 ends each text, and equal suffixes keep the order of their texts.
    """

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        """``length``: the longest prefix that `classes` will be asked about."""
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.ends = np.cumsum(size) - 1  # of each text's end symbol
        n = int(size.sum())
        self.symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
        self.symbols[self.ends] = 0
        if 3 * (n - 1).bit_length() > 64:
            raise ValueError("an index holds up to 2**21 symbols")
        self.order, self.ranks = self._sorted(n, int(size.max()), length)
        before = self.symbols[self.order - 1]
        before[self.order == 0] = 0
        first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        self.run_start = first
        self.run_symbol = before[first]
        run_length = np.diff(np.append(first, n))
        # sampled positions: text places of each run's first and last row
        self.head = self.order[first]
        self.tail = self.order[first + run_length - 1]
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        to = np.empty(len(first), np.int64)
        to[by_symbol] = np.cumsum(run_length[by_symbol]) - run_length[by_symbol]
        self.run_to = to  # row that LF gives a run's first row
        self.rows = n
        self.run_of = np.repeat(np.arange(len(first), dtype=np.int32), run_length)

    def _sorted(self, n: int, longest: int, length: int):
        """Suffix order by prefix doubling; a rank pair and the place fit one sortable integer."""
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        size = np.diff(np.concatenate(([-1], self.ends)))
        to_end = (np.repeat(self.ends, size) - np.arange(n)).astype(np.int32)  # symbols left in the text
        place = np.arange(n, dtype=np.uint64)
        ranks = self.symbols.astype(np.uint64)
        kept = {1: self.symbols}
        width, first = 1, max(1, min(5, (64 - int(bits)) // 9))
        key = ranks.copy()
        for i in range(1, first):
            key <<= np.uint64(9)
            key[:-i] |= np.where(to_end[:-i] >= i, ranks[i:], np.uint64(0))
        width = first
        while True:
            key <<= bits
            key |= place
            key.sort()
            order = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            key >>= bits
            level = np.zeros(n, np.uint64)
            np.cumsum(key[1:] != key[:-1], out=level[1:])
            ranks = np.empty(n, np.uint64)
            ranks[order] = level
            if width <= length:  # the widest of these tells the classes apart
                kept = {width: ranks.astype(np.uint32)}
            if width >= longest or int(level[-1]) == n - 1:
                return order, kept
            key = ranks << bits
            key[:-width] |= np.where(to_end[:-width] >= width, ranks[width:], np.uint64(0))
            width *= 2

    def step(self, row: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the row is preceded by the symbol, and the row of the longer suffix if so."""
        run = self.run_of[row]
        return self.run_symbol[run] == symbol, self.run_to[run] + row - self.run_start[run]

    def classes(self, length: int) -> np.ndarray:
        """First rows of the classes: suffixes with the same first ``length`` symbols."""
        width = max(w for w in self.ranks if w <= length)
        new = np.zeros(self.rows - 1, bool)
        for by in [*range(0, length - width, width), length - width]:
            near = self.ranks[width][np.minimum(self.order + by, self.rows - 1)]
            new |= near[1:] != near[:-1]
        return np.flatnonzero(np.concatenate(([True], new)))

    def statistics(self, pattern: bytes) -> list[tuple[int, int]]:
        """Matching statistics of any pattern: per place the longest match and a text place of it.

        Streams the pattern backwards. Where the row's symbol differs, the match goes on from the
        nearest run of that symbol above or below, whose sampled position gives the overlap.
        """
        row, size, at, out = 0, 0, int(self.order[0]), []
        for i in range(len(pattern) - 1, -1, -1):
            c = pattern[i] + 1
            run = int(self.run_of[row])
            if self.run_symbol[run] != c:
                same = np.flatnonzero(self.run_symbol == c)
                k = int(np.searchsorted(same, run))
                best = (-1, 0, 0)
                for j, sample, edge in ((k - 1, self.tail, 1), (k, self.head, 0)):
                    if 0 <= j < len(same):
                        r = int(same[j])
                        place = int(sample[r])
                        first = int(self.run_start[r + 1]) - 1 if edge and r + 1 < len(self.run_start) else self.rows - 1
                        new_row = first if edge else int(self.run_start[r])
                        best = max(best, (min(size, self._common(place, pattern[i + 1 :])), place, new_row))
                if best[0] < 0:
                    row, size, at = 0, 0, int(self.order[0])
                    out.append((0, -1))
                    continue
                size, at, row = best
                run = int(self.run_of[row])
            row = int(self.run_to[run] + row - self.run_start[run])
            size, at = size + 1, at - 1
            out.append((size, at))
        return out[::-1]

    def _common(self, place: int, pattern: bytes) -> int:
        n = 0
        while n < len(pattern) and self.symbols[place + n] == pattern[n] + 1:
            n += 1
        return n


def owners(texts: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """Per text and window of ``length`` bytes: the smallest doc_id among the texts that hold it."""
    index = MatchIndex(texts, length)
    first = index.classes(length)
    whose = np.repeat(docs, np.diff(np.concatenate(([-1], index.ends))))
    tag = np.repeat(np.minimum.reduceat(whose[index.order], first), np.diff(np.append(first, index.rows)))
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = np.maximum(size - length + 1, 0)
    offset = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), np.int64)
    # the end symbols' rows come first, in the order of the texts
    row = np.arange(len(texts))
    alive = np.arange(len(texts))
    for matched in range(1, int(size.max()) + 1):
        go = size[alive] >= matched
        alive, row = alive[go], row[go]
        at = index.ends[alive] - matched
        held, row = index.step(row, index.symbols[at])
        if not held.all():
            raise AssertionError("an indexed text must be found")
        if matched >= length:
            out[offset[alive] + size[alive] - matched] = tag[row]
    return np.split(out, np.cumsum(windows)[:-1])


def _settled(table: pa.Table, length: int) -> list[tuple[int, int, bytes]]:
    """For one bucket: per block its piece steps and a bit per window that another document owns."""
    place: dict[tuple[int, bytes], int] = {}
    least: list[int] = []
    came = []
    for block, n, body in zip(table["block"].to_pylist(), table["n"].to_pylist(), table["body"].to_pylist()):
        steps, key, doc, texts = _received(n, body)
        at = []
        for k, d, t in zip(key.tolist(), doc.tolist(), texts):
            p = place.setdefault((k, t), len(least))
            if p == len(least):
                least.append(d)
            elif d < least[p]:
                least[p] = d
            at.append(p)
        came.append((block, steps, doc, np.array(at, np.int64)))
    keys = np.fromiter((k for k, _ in place), np.uint64, len(place))
    texts = [t for _, t in place]
    least_doc = np.array(least, np.int64)
    owner: list[np.ndarray] = [None] * len(texts)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    groups = np.split(order, first[1:])
    batch: list[int] = []
    weight = 0

    def flush():
        nonlocal batch, weight
        if batch:
            for i, own in zip(batch, owners([texts[i] for i in batch], least_doc[batch], length)):
                owner[i] = own
        batch, weight = [], 0

    for group in groups:
        if len(group) == 1:
            i = int(group[0])
            owner[i] = np.full(len(texts[i]) - length + 1, least_doc[i])
            continue
        if weight > BUCKET:
            flush()
        batch += group.tolist()
        weight += sum(len(texts[i]) + 1 for i in group.tolist())
    flush()
    width = np.fromiter((len(o) for o in owner), np.int64, len(owner))
    shift = np.cumsum(width) - width
    flat = np.concatenate(owner)
    out = []
    for block, steps, doc, at in came:
        size = width[at]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        taken = flat[np.repeat(shift[at], size) + inside] < np.repeat(doc, size)
        bits = np.add.reduceat(taken.astype(np.uint32) << inside.astype(np.uint32), np.cumsum(size) - size, dtype=np.uint32)
        out.append((block, len(at), exchange.packed(steps, bits)))
    return out


def _owned(pieces: DataFrame, length: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        block, n, body = zip(*_settled(table, length))
        return pa.table({"block": pa.array(block, pa.int64()), "n": pa.array(n, pa.int64()), "bits": pa.array(body, pa.binary())})

    return pieces.where("bucket >= 0").groupBy("bucket").applyInArrow(run, "block long, n long, bits binary")


# marks

def _covered(block: Block, table: pa.Table, length: int) -> np.ndarray:
    """Which bytes of the block are covered by a window that an earlier document owns."""
    mark = np.zeros(len(block.data) + 1, np.int32)
    for plan in table["plan"].drop_null().to_pylist():
        raw = exchange.unpacked(plan)
        n, count = np.frombuffer(raw, np.int64, 2).tolist()
        at, piece = (np.cumsum(np.frombuffer(raw, np.int32, n, 16 + 4 * n * i), dtype=np.int64) for i in range(2))
        width = np.frombuffer(raw, np.uint8, count, 16 + 8 * n).astype(np.int64)
        whose = block.ids[np.searchsorted(block.begins, at, "right") - 1]
        own = np.full(count, _NONE)
        np.minimum.at(own, piece, whose)
        bits = np.zeros(count, np.uint32)
        for got, k in zip(table["bits"].to_pylist(), table["n"].to_pylist()):
            if got is not None:
                body = exchange.unpacked(got)
                number = np.cumsum(np.frombuffer(body, np.uint32, k), dtype=np.int64)
                bits[number] = np.frombuffer(body, np.uint32, k, 4 * k)
        all_of = (np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)
        later = whose > own[piece]  # another document of this block comes first
        word = np.where(later, all_of[piece], bits[piece].astype(np.uint64))
        for j in range(int(width.max()) if count else 0):
            hit = at[(word >> np.uint64(j)) & np.uint64(1) == 1] + j
            np.add.at(mark, hit, 1)
            np.add.at(mark, hit + length, -1)
        for place in np.frombuffer(raw[16 + 8 * n + count :], np.int32).tolist():
            mark[block.begins[place]] += 1
            mark[block.ends[place]] -= 1
    return np.cumsum(mark[:-1]) > 0


RESULT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept_text", T.StringType()),
    ]
)


def _at_characters(gone: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Shrink removed runs so that no character is cut."""
    tail = (data & 0xC0) == 0x80
    first = np.flatnonzero(~tail)
    if not len(first):
        return gone
    return np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.append(first, len(data))))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, texts: bool = True
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    ``kept_text`` is what is left, with removed runs shrunk to whole characters; the other columns
    are about bytes. ``texts=False`` leaves kept_text null. ``length`` is 24 to 200.
    """
    if not GRAM < length <= 224:
        raise ValueError("length must be above the anchor's bytes and fit a piece")
    spark = docs.sparkSession
    docs = docs.select([c for c in docs.columns if c not in RESULT.names])
    names = docs.columns
    packed = docs if texts else docs.select(doc_id, text)
    names = packed.columns
    blocks = stored(pack(packed, doc_id, text, length), "blocks")
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_keys = exchange.buckets_for(spark, total // 16)
    answers = exchange.answer(exchange.ask(blocks, _keys_of(length), n_keys), flagged=True)
    copied = copies(blocks)
    known = answers.unionByName(copied, allowMissingColumns=True)
    n = max(n_keys, -(-int(total) // (4 * BUCKET)))
    pieces = stored(_pieces(blocks, known, n_keys, n, length), "pieces")
    dropped(copied)
    plans = pieces.where("bucket < 0").select("block", F.col("body").alias("plan"))
    verdicts = plans.unionByName(_owned(pieces, length), allowMissingColumns=True)
    kept = [T.StructField(f.name, T.LongType(), True) if f.name == doc_id else f for f in packed.schema.fields]
    schema = T.StructType([*kept, *RESULT.fields])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for payload in left["payload"]:
            block = Block(payload.as_buffer())
            gone = _covered(block, right, length)
            whole = _at_characters(gone, block.data) if texts else None
            rows = {f.name: [] for f in RESULT.fields}
            for a, b in zip(block.begins.tolist(), block.ends.tolist()):
                cut = gone[a:b]
                rows["n_bytes"].append(b - a)
                rows["n_removed"].append(int(np.count_nonzero(cut)))
                rows["n_spans"].append(int(np.count_nonzero(cut[1:] & ~cut[:-1])) + int(b > a and cut[0]))
                rows["kept_sha256"].append(hashlib.sha256(block.data[a:b][~cut].tobytes()).hexdigest())
                rows["kept_text"].append(block.data[a:b][~whole[a:b]].tobytes().decode("utf-8", "replace") if texts else None)
            columns = {c: block.table.column({doc_id: 0, text: 1}.get(c, c)) for c in names}
            parts.append(pa.table(columns | {k: pa.array(v, pa.string() if k.startswith("kept") else pa.int64()) for k, v in rows.items()}))
        return pa.concat_tables(parts)

    got = blocks.select("block", "payload").groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(run, schema)
    return got if texts else got.drop(text)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with repeated passages cut out; a document that had nothing else goes."""
    marked = remove_repeats(docs, doc_id, text, length)
    left = marked.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    return left.withColumn(text, F.when(F.col("n_removed") == 0, F.col(text)).otherwise(F.col("kept_text"))).select(docs.columns)
