"""Nearest neighbours by cosine with an inverted multi-index.

Vectors are scaled to length one and cut in two halves; each half has its own codebook, fitted on a
sample of at most ``SAMPLE`` distinct vectors (the smallest digests, so reruns agree). A cell is a pair
of centroids. A query walks the pairs in the order of their summed distances with a heap until the
cells hold ``candidates`` vectors, and all vectors of these cells are scored on the original numbers in
double precision.

Every valid vector is indexed. Equal vectors are one entry that keeps its smallest ``k + 1`` ids, which
is all that any answer can need, so a vector held by a third of all rows is scored once. Cells are dealt
to shards of about ``PART`` entries; a larger cell has several. The number of centroids grows with the square root of the entries
up to ``CENTROIDS`` per half; the table of cell sizes is bounded by its square and is broadcast.

Vectors that are null, zero, of a length other than the table's most frequent one, or that hold null or
non-finite components take no part, nor do rows without an id. Repeated rows of an id are one. Fewer
candidates than ``k`` give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliomart.llm.stages import stored

SAMPLE = 20_000
CENTROIDS = 256
CELL = 16
PART = 4096
TRIALS = 128


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part, each id once per vector."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull())
    rows = rows.where((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    most = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size(v) == (most[0] if most else 0))


def fit(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 6) -> np.ndarray:
    """Centroids by Lloyd's algorithm."""
    pick = np.random.Generator(np.random.PCG64(seed)).choice(len(sample), k, replace=False)
    centers = sample[np.sort(pick)].copy()
    for _ in range(rounds):
        near = nearest(sample, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=k)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ centers.T + (centers**2).sum(1)[None, :]


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(rows[a : a + 4096], centers).argmin(1) for a in range(0, len(rows), 4096)])


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, least: int) -> list[int]:
    """Cells in the order of summed distances until they hold ``least`` entries; empty cells are left out."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, cells, held = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < least:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(right) + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return cells


def _matrix(column) -> np.ndarray:
    """An Arrow list column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines row by row, each by the same sums, so equal vectors score equally."""
    dots = np.einsum("ij,j->i", rows, query)
    return dots / (np.sqrt(np.einsum("ij,ij->i", rows, rows)) * np.sqrt(np.einsum("j,j->", query, query)))


class Codebooks:
    def __init__(self, sample: np.ndarray, k: int):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.at = max(1, unit.shape[1] // 2)
        self.left = fit(unit[:, : self.at], k)
        self.right = fit(unit[:, self.at :], k) if unit.shape[1] > self.at else np.zeros((1, 0))

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        return unit[:, : self.at], unit[:, self.at :]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        left, right = self.halves(rows)
        return nearest(left, self.left) * len(self.right) + nearest(right, self.right)


def top(query: np.ndarray, rows: np.ndarray, first: np.ndarray, near: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The ``k`` best rows by exact score, ties to the smaller id, given products that are right to rounding."""
    if len(rows) > k:
        least = np.partition(near, len(near) - k)[len(near) - k]
        some = np.flatnonzero(near >= least - 1e-9 * max(1.0, abs(least)))
    else:
        some = np.arange(len(rows))
    exact = scores(query, rows[some])
    return [(int(some[i]), float(exact[i])) for i in np.lexsort((first[some], -exact))[:k]]


def _calibrated(placed: DataFrame, sample: list[tuple[int, list[float]]], books: Codebooks, sizes: np.ndarray, k: int, recall: float) -> int:
    """Candidates that reach the recall on sample queries, which are compared with every entry."""
    spark = placed.sparkSession
    ids = np.array([i for i, _ in sample], np.int64)
    shared = spark.sparkContext.broadcast((ids, np.array([v for _, v in sample], np.float64)))

    def nearest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = shared.value
        unit = asked / np.linalg.norm(asked, axis=1, keepdims=True)
        for batch in batches:
            rows = _matrix(batch.column(0))
            if not len(rows):
                continue
            first, cell = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            near = unit @ (rows / np.linalg.norm(rows, axis=1, keepdims=True)).T
            near[ids[:, None] == first[None, :]] = -2
            best = np.argsort(-near, axis=1, kind="stable")[:, :k]
            at = np.repeat(np.arange(len(ids)), best.shape[1])
            best = best.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(near[at, best]), pa.array(cell[best], pa.int32())], names=["at", "near", "cell"]
            )

    found = placed.select("vec", "first", "cell").mapInArrow(nearest_of, "at int, near double, cell int").where("near > -2")
    best = W.partitionBy("at").orderBy(F.desc("near"))
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).collect()  # k rows per sample query
    left, right = books.halves(shared.value[1])
    left, right = distances(left, books.left), distances(right, books.right)
    needed = []
    for i in range(len(ids)):
        cells = walk(left[i], right[i], sizes, int(sizes.sum()))
        held = dict(zip(cells, np.cumsum(sizes[cells]).tolist()))
        needed += [held[r["cell"]] for r in found if r["at"] == i]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, candidates: int | None = None, recall: float = 0.96,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found for the rows of ``queries``: query_id, rank, vec_id, score.

    Without ``candidates`` their number is what ``TRIALS`` sample queries need for ``recall``.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stored(valid(vectors, vec_id, vector), "vectors")
    ranked = rows.distinct().withColumn("n", F.row_number().over(W.partitionBy("vec").orderBy("id"))).where(F.col("n") <= k + 1)
    entries = stored(
        ranked.groupBy("vec").agg(F.min("id").alias("first"), F.array_sort(F.collect_list("id")).alias("ids")), "entries"
    )
    total = entries.count()
    if not total:
        return empty
    sample = entries.select("first", "vec", F.xxhash64("vec").alias("digest")).orderBy("digest").limit(SAMPLE)
    sample = [(r["first"], r["vec"]) for r in sample.collect()]
    n = int(min(CENTROIDS, len(sample), max(1, round((total / CELL) ** 0.5))))
    codebooks = Codebooks(np.array([v for _, v in sample], np.float64), n)
    books = spark.sparkContext.broadcast(codebooks)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = books.value.cells(_matrix(batch.column(0))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=["vec", "first", "ids", "cell"])

    placed = stored(
        entries.select("vec", "first", "ids").mapInArrow(place, "vec array<double>, first long, ids array<long>, cell int"), "cells"
    )
    sizes = np.zeros(n * len(codebooks.right), np.int64)
    for cell, count in placed.groupBy("cell").count().collect():  # at most CENTROIDS ** 2 numbers
        sizes[cell] = count
    if candidates is None:
        candidates = _calibrated(placed, sample[:TRIALS], codebooks, sizes, k, recall)
    shard, parts = dealt(sizes)
    shared = spark.sparkContext.broadcast((sizes, shard, parts))

    asked = valid(queries, vec_id, vector).distinct().join(entries.select("vec", "first"), "vec")
    asked = stored(asked.select(F.col("id").alias("query_id"), F.col("first").alias("query")), "asked")
    wanted = placed.join(asked.select(F.col("query").alias("first")).distinct(), "first", "left_semi").select("first", "vec")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, shard, parts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = books.value.halves(_matrix(batch.column(1)))
            left, right = distances(left, books.value.left), distances(right, books.value.right)
            at, where, cells = [], [], []
            for i in range(batch.num_rows):
                by: dict[int, list[int]] = {}
                for c in walk(left[i], right[i], sizes, candidates):
                    for p in range(parts[c]):
                        by.setdefault(int(shard[c]) + p, []).append(c)
                at += [i] * len(by)
                where += by.keys()
                cells += by.values()
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(where, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                names=["first", "vec", "shard", "cells"],
            )

    routed = wanted.mapInArrow(route, "first long, vec array<double>, shard int, cells array<int>")

    def dealt_to(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, shard, parts = shared.value
        for batch in batches:
            cell, first = np.asarray(batch.column(3), np.int64), np.asarray(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard[cell] + first % parts[cell], pa.int32())], names=["vec", "first", "ids", "cell", "shard"]
            )

    there = placed.mapInArrow(dealt_to, "vec array<double>, first long, ids array<long>, cell int, shard int")

    def score(key, asked: pa.Table, there: pa.Table) -> pa.Table:
        out = {"query": [], "first": [], "ids": [], "score": []}
        if asked.num_rows and there.num_rows:
            rows, first, cell = _matrix(there["vec"]), np.asarray(there["first"]), np.asarray(there["cell"])
            unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
            order = np.argsort(cell, kind="stable")
            by = dict(zip(cell[order].tolist(), [0] * len(cell)))
            for c, own in zip(by, np.split(order, np.flatnonzero(np.diff(cell[order])) + 1)):
                by[c] = own
            vectors = _matrix(asked["vec"])
            for query, vec, cells in zip(asked["first"].to_pylist(), vectors, asked["cells"].to_pylist()):
                own = [by[c] for c in cells if c in by]
                if not own:
                    continue
                own = np.concatenate(own)
                near = unit[own] @ (vec / np.linalg.norm(vec))
                for i, exact in top(vec, rows[own], first[own], near, k + 1):
                    out["query"].append(query)
                    out["first"].append(int(first[own[i]]))
                    out["ids"].append(there["ids"][int(own[i])].as_py())
                    out["score"].append(exact)
        return pa.table(
            {
                "query": pa.array(out["query"], pa.int64()), "first": pa.array(out["first"], pa.int64()),
                "ids": pa.array(out["ids"], pa.list_(pa.int64())), "score": pa.array(out["score"], pa.float64()),
            }
        )

    found = routed.groupBy("shard").cogroup(there.groupBy("shard")).applyInArrow(
        score, "query long, first long, ids array<long>, score double"
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "first")
    near = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    near = stored(near.select("query", "score", "ids"), "near")
    each = near.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("near"))  # k + 1 entries
    answer = asked.join(each, "query").select("query_id", F.explode("near").alias("x"))
    answer = answer.select("query_id", "x.score", F.explode("x.ids").alias("vec_id")).where("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answer = answer.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return answer.select("query_id", "rank", "vec_id", "score")


def dealt(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shard of each cell and how many it has: small cells share one, a large cell has several."""
    shard, parts, now, held = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for c, n in enumerate(sizes.tolist()):
        if held and held + n > PART:
            now, held = now + 1, 0
        shard[c] = now
        if n > PART:
            parts[c] = -(-n // PART)
            now, held = now + int(parts[c]), 0
        else:
            held += n
    return shard, parts
