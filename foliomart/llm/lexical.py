"""Ranked lexical search: documents of an item are grouped by the mask of the terms they hold.

Terms are the maximal runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A term's
weight is floor(1000 * ln((2N + 2) / (2df + 1))); a document scores the sum of weight times
(10**9 * tf) div (1000 * tf + 8 * m) over the item's terms, m being 10 + (90 * n * N) div L.

1. Whole texts are cut into terms once; a row per document keeps its length and the counts of the terms
   that some item asks for. Document frequencies, N and L are sums over these rows.
2. Each task walks its rows batch by batch. For an item, the postings of its j-th term OR the bit j into
   the masks of their documents; documents of one mask form a group. A group cannot score more than
   the sum, over the mask's bits, of the term's weight times its largest factor in the batch.
3. Groups are scored exactly from the highest bound down, and the rest is left out once the item's k-th
   score is above the next bound (a group at the k-th score itself may hold a smaller doc_id, so it is
   scored). The k best of an item go on to the next batch, so later batches stop sooner.
4. A task gives at most k rows per item; these are merged per item in two levels.

Nothing is sampled or capped: stopping leaves out only what cannot be among the k best. Items are taken
in blocks of about ``ITEM_CHARS`` characters of text, which bounds what tasks keep of them; documents are
not grouped or shuffled by term, so a frequent word or a large group of copies stays where it is.

Null text holds no terms. Documents without terms do not count for N. Rows that repeat a doc_id are
documents of their own and may both be found; a null doc_id comes last among equal scores. Rows of
``items`` with one item_id (also null) are one item with all their terms. An item without a document
gives no row, and so does an empty table. Other columns of either table are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliomart.llm.stages import stored
from foliomart.llm.texts import encoded

ITEM_CHARS = 4_000_000
#: Bytes of a text that are cut into terms at once.
SLICE = 1 << 20
#: Documents scored before the bound is looked at again; doubles from step to step.
FIRST_STEP = 64
PARTS = 64
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_ROWS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
_FOUND = pa.schema([("item_id", pa.int64()), ("score", pa.int64()), ("doc_id", pa.int64())])


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, slice by slice."""
    folded = raw.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _items(block: DataFrame) -> dict[int | None, set[bytes]]:
    asked: dict[int | None, set[bytes]] = {}
    for who, text in block.collect():
        mine = asked.setdefault(who, set())
        for found in terms_of((text or "").encode()):
            mine.update(found)
    return asked


def _counted(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs): a document's terms with repeats, and the counts of those with a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, tfs, ends = [], [], [], [0]
            for raw in encoded(batch.column(1)):
                n, counts = 0, Counter()
                for found in terms_of(raw):
                    n += len(found)
                    counts.update(map(number.get, found))
                counts.pop(None, None)
                sizes.append(n)
                flat.extend(counts.keys())
                tfs.extend(counts.values())
                ends.append(len(flat))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ],
                schema=_ROWS,
            )

    return docs.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<long>")


class Postings:
    """The postings of a batch by term: local documents in rising order and their factors."""

    def __init__(self, batch: pa.RecordBatch, n_terms: int, n_docs: int, n_all: int):
        lengths = batch.column(1).to_numpy(zero_copy_only=False)
        lists = batch.column(2)
        starts = lists.offsets.to_numpy()
        terms = lists.values.to_numpy()[starts[0] : starts[-1]]
        other = batch.column(3)
        tfs = other.values.to_numpy()[other.offsets[0].as_py() : other.offsets[-1].as_py()]
        self.size = len(lengths)
        m = 10 + (90 * lengths * n_docs) // max(n_all, 1)
        docs = np.repeat(np.arange(self.size), np.diff(starts))
        factors = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs])
        order = np.argsort(terms, kind="stable")
        self.docs, self.factors = docs[order], factors[order]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=n_terms))))
        held = self.ends[1:] > self.ends[:-1]
        self.most = np.zeros(n_terms, np.int64)
        if len(order):
            self.most[held] = np.maximum.reduceat(self.factors, self.ends[:-1][held])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[term], self.ends[term + 1]
        return self.docs[a:b], self.factors[a:b]


def masks(postings: Postings, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct masks (one row each, 64 terms a word), the documents ordered by mask, and where each mask's begin."""
    words = -(-len(terms) // 64)
    mask = np.zeros((postings.size, words), np.uint64)
    for j, term in enumerate(terms):
        mask[postings.of(term)[0], j >> 6] |= np.uint64(1 << (j & 63))
    docs = np.flatnonzero(mask.any(axis=1))
    mask = mask[docs]
    order = np.lexsort(mask.T)
    mask, docs = mask[order], docs[order]
    fresh = np.concatenate(([True], (mask[1:] != mask[:-1]).any(axis=1))) if len(docs) else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    return mask[starts], docs, np.append(starts, len(docs))


def bounds(distinct: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The highest score a document of each mask could have; ``most`` is per term."""
    total = np.zeros(len(distinct), np.int64)
    for j, value in enumerate(most.tolist()):
        total += ((distinct[:, j >> 6] >> np.uint64(j & 63)) & np.uint64(1)).astype(np.int64) * value
    return total


class Best:
    """The k best documents of an item so far: by score, then by doc_id with null last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.unnamed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def limit(self) -> int:
        """Scores below this are out; 1 as long as there is room, as a score must be above 0."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def take(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        good = scores >= self.limit()
        scores = np.concatenate((self.scores, scores[good]))
        ids = np.concatenate((self.ids, ids[good]))
        unnamed = np.concatenate((self.unnamed, unnamed[good]))
        order = np.lexsort((ids, unnamed, -scores))[: self.k]
        self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]


def _scores(postings: Postings, terms: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(docs), np.int64)
    for term, weight in zip(terms.tolist(), weights.tolist()):
        own, factors = postings.of(term)
        at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
        total += np.where(own[at] == docs, factors[at] * weight, 0)
    return total


def look(postings: Postings, ids: np.ndarray, unnamed: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Take a batch's documents into an item's best; gives how many were scored."""
    held = postings.most[terms] > 0
    terms, weights = terms[held], weights[held]
    most = postings.most[terms] * weights
    if int(most.sum()) < best.limit():
        return 0
    distinct, docs, starts = masks(postings, terms)
    bound = bounds(distinct, most)
    order = np.argsort(-bound, kind="stable")
    sizes = np.cumsum((starts[1:] - starts[:-1])[order])
    bound, begin, done, step = bound[order], 0, 0, FIRST_STEP
    while begin < len(order) and bound[begin] >= best.limit():
        end = min(int(np.searchsorted(sizes, done + step)) + 1, len(order))
        end = max(begin + 1, int(np.searchsorted(-bound[:end], -best.limit(), side="right")))
        chosen = np.sort(np.concatenate([docs[starts[g] : starts[g + 1]] for g in order[begin:end]]))
        best.take(_scores(postings, terms, weights, chosen), ids[chosen], unnamed[chosen])
        begin, done, step = end, int(sizes[end - 1]), 2 * step
    return done


def _search_block(docs: DataFrame, asked: dict[int | None, set[bytes]], k: int) -> DataFrame:
    vocabulary = sorted(set().union(*asked.values()))
    number = {t: i for i, t in enumerate(vocabulary)}
    rows = stored(_counted(docs, number), "counted-terms")
    n_docs, n_all = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most one row per term of the block
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for term, df in held:
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    wanted = []
    for who, mine in asked.items():
        terms = np.array(sorted(number[t] for t in mine), np.int64)
        terms = terms[weight[terms] > 0]
        if len(terms):
            wanted.append((who, terms, weight[terms]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in wanted]
        for batch in batches:
            if not batch.num_rows:
                continue
            postings = Postings(batch, len(weight), n_docs, n_all)
            unnamed = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            for (_, terms, weights), own in zip(wanted, best):
                look(postings, ids, unnamed, terms, weights, own)
        for (who, _, _), own in zip(wanted, best):
            if len(own.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([who] * len(own.scores), pa.int64()), pa.array(own.scores),
                        pa.array(own.ids, mask=own.unnamed),
                    ],
                    schema=_FOUND,
                )

    return rows.mapInArrow(run, "item_id long, score long, doc_id long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for every item. Ids are integers."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // item_chars))
    found = []
    for i in range(blocks):
        asked = _items(items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i))
        if asked or not found:
            found.append(_search_block(docs, asked, k))
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    every = reduce(DataFrame.unionByName, found).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    few = every.withColumn("rank", F.row_number().over(W.partitionBy("item_id", "part").orderBy(*best))).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
