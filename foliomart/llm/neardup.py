"""Near duplicates by word shingles: an inverted join over MinHash signature coordinates.

Documents with equal shingle sets are one class. Each class has a signature of ``M`` coordinates; a
posting is a (coordinate, value) pair. Two sets of similarity s agree on about s*M coordinates, so a
pair is a candidate if it agrees on ``MATCHES`` or more; at s = 0.8 and 36 of 64 fewer agree with a
chance of about 4e-6. Such a pair must share one of the ``M - MATCHES + 1`` rarest postings of either
side: only this prefix is posted, frequent values are skipped, and postings held by one class alone
lead nowhere and are left out.

Postings are not joined with themselves. The member of a posting whose postings are most frequent is
its hub (in a group of edited copies this is the text they derive from), and the postings of one hub
are merged. Members are verified on full shingle sets, first against the hub, then those that did not
join it against the others, by merging the posting lists of their coordinates and shingles and skipping
pairs already connected. So each group gives at most one link per
member. A hub's members are dealt to parts of bounded size; members that did not join the hub are also
compared with the other parts, in chunks of bounded size. Links are confirmed exactly, and classes connected through links share
the smallest doc_id as component.

Null or wordless text: empty set, linked with nothing. Null doc_id: such a row takes no part and is
its own component (null). Repeated rows are members of one class. Columns named like the result's are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomart.llm import exchange
from foliomart.llm.components import components
from foliomart.llm.texts import encoded, mixed, shingles, slices, word_hashes
from foliomart.llm.stages import dropped, stored, unused

M = 64
MATCHES = 36
PART_BYTES = 16 << 20
PART_ROWS = 2048
_SEED = np.random.Generator(np.random.PCG64(9)).integers(1, 2**63, (2, M)).astype(np.uint64)
_MUL, _ADD = _SEED[0][:, None] * np.uint64(2) + np.uint64(1), _SEED[1][:, None]
_PLACE = np.arange(M, dtype=np.uint64) << np.uint64(58)


def signature(items: np.ndarray) -> np.ndarray:
    """The smallest value of each of M hash orders, as 32 bits.

    The smallest of many values begins with zeros, more of them the longer the text, so it is mixed before it is cut:
    else texts would share values by chance, the more of them the larger the table.
    """
    least = np.full(M, 2**64 - 1, np.uint64)
    for a in range(0, len(items), 4096):
        least = np.minimum(least, (items[None, a : a + 4096] * _MUL + _ADD).min(axis=1))
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def _sets(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), encoded(batch.column(1))
            for a, b in slices([len(x) for x in texts], 1 << 19):
                words, off = word_hashes(texts[a:b], lower=True)
                got = [shingles(words[off[i] : off[i + 1]], n) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array([len(x) for x in got], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).digest()[:16] if len(x) else None for x in got], pa.binary()),
                        pa.array([signature(x).tobytes() if len(x) else None for x in got], pa.binary()),
                    ],
                    names=["doc", "n_shingles", "class", "sig"],
                )

    return docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, "doc long, n_shingles long, class binary, sig binary"
    )


def _blocks(classes: DataFrame) -> DataFrame:
    """Classes packed into blocks: ids and signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                ids = np.asarray(batch.column(0).slice(a, 4096), np.int64)
                sigs = b"".join(batch.column(1).slice(a, 4096).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes() + sigs], pa.binary())], names=["payload"])

    return classes.select("node", "sig").mapInArrow(run, "payload binary")


def _tokens(payload) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(payload) // (8 + 4 * M)
    ids = np.frombuffer(payload, np.int64, n)
    sigs = np.frombuffer(payload, np.uint32, n * M, 8 * n).reshape(n, M)
    return ids, sigs, mixed(sigs.astype(np.uint64) | _PLACE[None, :])


def _keys(payload) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(_tokens(payload)[2], return_counts=True)


def _postings(blocks: DataFrame, answers: DataFrame, n_buckets: int) -> DataFrame:
    """(posting, node, score): the rarest shared postings of each class; score: how common its values are."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for payload in left["payload"]:
            ids, _, tokens = _tokens(payload.as_buffer())
            keys, back = np.unique(tokens, return_inverse=True)
            held = exchange.answered(right, keys, n_buckets)[back.reshape(tokens.shape)].astype(np.int64)
            order = np.lexsort((tokens, held), axis=1)[:, : M - MATCHES + 1]
            few = np.take_along_axis(held, order, 1)
            row, col = np.nonzero(few > 1)
            score = np.log2(held).sum(axis=1)
            out.append((np.take_along_axis(tokens, order, 1)[row, col].view(np.int64), ids[row], score[row]))
        post, node, score = (np.concatenate(x) for x in zip(*out)) if out else ([], [], [])
        return pa.table({"posting": pa.array(post, pa.int64()), "node": pa.array(node, pa.int64()), "score": pa.array(score, pa.float64())})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "posting long, node long, score double")


def _members(postings: DataFrame) -> DataFrame:
    """(hub, node): each class with the hubs of its postings, hubs with themselves."""
    best = F.max(F.struct("score", F.negative("node").alias("low")))
    hubs = postings.groupBy("posting").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.where("n > 1").select("posting", F.negative("best.low").alias("hub"))
    hubs = stored(hubs, "hubs")
    found = stored(postings.join(hubs, "posting").select("hub", "node").distinct(), "members")
    dropped(hubs)
    return found


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b|, on sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Lists:
    """Posting lists of a part's tokens; lists with the same members are one list with a weight.

    Pages of one template share most of their shingles, so their long lists shrink to a few.
    """

    LONG = 64
    CELLS = 1 << 22

    def __init__(self, tokens: list[np.ndarray]):
        self.n = len(tokens)
        member = np.repeat(np.arange(self.n), [len(x) for x in tokens])
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, member = flat[order], member[order]
        begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, len(flat)))
        named = np.add.reduceat(mixed(member.astype(np.uint64) + np.uint64(1)), begin) if len(flat) else flat
        shared = np.flatnonzero(count > 1)
        _, one, weight = np.unique(named[shared], return_index=True, return_counts=True)
        begin, count = begin[shared[one]], count[shared[one]]
        self.short = self._kept(member, begin, count, weight, count <= self.LONG)
        self.long = self._kept(member, begin, count, weight, count > self.LONG)

    @staticmethod
    def _kept(member, begin, count, weight, these):
        """(members list by list, list of each, begin and count of each list, weights)."""
        begin, count = begin[these], count[these]
        flat = member[_ranges(begin, count)]
        return flat, np.repeat(np.arange(len(count)), count), np.cumsum(count) - count, count, weight[these]

    def overlaps(self, rows: np.ndarray) -> np.ndarray:
        """How many tokens each of ``rows`` has in common with each member."""
        member, which, begin, count, weight = self.short
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        asked = np.flatnonzero(place[member] >= 0)
        lists = which[asked]
        out = np.zeros(len(rows) * self.n)
        # a row of many tokens meets each of its lists whole, so the pairs are counted some at a time
        for a, b in slices(count[lists].tolist(), self.CELLS):
            some, held = lists[a:b], count[lists[a:b]]
            cell = np.repeat(place[member[asked[a:b]]] * self.n, held) + member[_ranges(begin[some], held)]
            out += np.bincount(cell, np.repeat(weight[some], held), len(out))
        out = out.reshape(len(rows), self.n)
        member, which, begin, count, weight = self.long
        width = max(1, self.CELLS // max(1, self.n))
        for a in range(0, len(count), width):
            own = slice(begin[a], begin[a] + count[a : a + width].sum())
            held = np.zeros((self.n, len(count[a : a + width])), np.float32)
            held[member[own], which[own] - a] = 1
            out += (held[rows] * weight[a : a + width].astype(np.float32)) @ held.T
        return np.rint(out).astype(np.int64)


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of each range, one after another."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def links_inside(ids: list[int], sets: list[np.ndarray], sigs: np.ndarray, first: int, percent: int,
                 also: set[int] | None = None) -> tuple[list[tuple[int, int]], set[int]]:
    """Links that connect whatever confirmed pairs connect, and the places that joined ``first``.

    All are compared with ``first``, then those that did not join it with all; with ``also`` only these
    places with all. Collisions and common shingles of many pairs are counted at once from posting lists.
    """
    label = np.arange(len(ids))
    links = []

    def joined(i: int, places: np.ndarray) -> None:
        for j in places[label[places] != label[i]].tolist():
            if label[i] != label[j] and jaccard_at_least(sets[i], sets[j], percent):
                label[label == label[j]] = label[i]
                links.append((ids[i], ids[j]))

    if also is None:
        joined(first, np.flatnonzero(np.count_nonzero(sigs == sigs[first], axis=1) >= MATCHES))
        rest = np.flatnonzero(label != label[first])
    else:
        rest = np.array(sorted(also), np.int64)
    if len(rest):
        postings = Lists(list(mixed(sigs.astype(np.uint64) | _PLACE[None, :])))
        common = Lists(sets)
        size = np.array([len(x) for x in sets])
        for a in range(0, len(rest), 256):
            rows = rest[a : a + 256]
            both = common.overlaps(rows)
            near = (postings.overlaps(rows) >= MATCHES) & (100 * both >= percent * (size[rows][:, None] + size - both))
            for i, row in zip(rows.tolist(), near):
                joined(i, np.flatnonzero(row))
    return links, set(np.flatnonzero(label == label[first]).tolist())


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes."""
    sized = sets.groupBy("node").agg(F.max(F.octet_length("items")).alias("bytes"))
    share = F.ceil(F.greatest(F.lit(1), F.sum("bytes") / PART_BYTES, F.count(F.lit(1)) / PART_ROWS)).cast("int")
    load = stored(members.join(sized, "node").groupBy("hub").agg(share.alias("parts")), "load")
    at = members.join(load, "hub").select("hub", "node", "parts", F.pmod(F.hash("node"), "parts").alias("part"))
    # the hub itself stands in every part
    at = at.where("hub <> node").unionByName(
        at.where("hub = node").select("hub", "node", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )
    full = at.join(sets, "node").select("hub", "part", "parts", "node", "items", "sig")

    def unpacked(table: pa.Table):
        order = np.lexsort((np.asarray(table["node"]),))
        table = table.take(pa.array(order))
        items = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"]]
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, M)
        return table["node"].to_pylist(), items, sigs

    def inside(table: pa.Table) -> pa.Table:
        ids, items, sigs = unpacked(table)
        hub = table["hub"][0].as_py()
        first = ids.index(hub) if hub in ids else 0
        links, joined = links_inside(ids, items, sigs, first, percent)
        apart = [ids[i] for i in range(len(ids)) if i not in joined] if table["parts"][0].as_py() > 1 else []
        return pa.table(
            {
                "hub": pa.array([hub] * (len(links) + len(apart)), pa.int64()),
                "a": pa.array([x for x, _ in links] + apart, pa.int64()),
                "b": pa.array([y for _, y in links] + [None] * len(apart), pa.int64()),
            }
        )

    found = stored(
        full.groupBy("hub", "part").applyInArrow(inside, "hub long, a long, b long"), "found")
    links = found.where("b IS NOT NULL").select("a", "b")
    # hubs of several parts: what did not join the hub visits every part, in chunks of bounded size
    apart = found.where("b IS NULL").select("hub", F.col("a").alias("node")).distinct().join(load.where("parts > 1"), "hub")
    chunked = apart.join(sized, "node").groupBy("hub").agg(share.alias("chunks"))
    chunked = stored(chunked, "chunks")
    guests = (
        apart.join(chunked, "hub")
        .select("hub", "node", F.pmod(F.hash("node"), "chunks").alias("chunk"),
                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .join(sets, "node").select("hub", "part", "chunk", "node", "items", "sig", F.lit(True).alias("guest"))
    )
    hosts = at.join(chunked, "hub").select(
        "hub", "part", "node", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    hosts = hosts.join(sets, "node").select("hub", "part", "chunk", "node", "items", "sig", F.lit(False).alias("guest"))

    def across(table: pa.Table) -> pa.Table:
        asked = set(table.filter(table["guest"])["node"].to_pylist())
        ids, items, sigs = unpacked(table)
        links, _ = links_inside(ids, items, sigs, 0, percent, {i for i, x in enumerate(ids) if x in asked})
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    crossed = guests.unionByName(hosts).groupBy("hub", "part", "chunk").applyInArrow(across, "a long, b long")
    links = stored(links.unionByName(crossed).where("a <> b").distinct(), "links")
    dropped(load, found, chunked)
    return links


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept`` (the smallest doc_id of its component)."""
    docs = docs.select([c for c in docs.columns if c not in ("n_shingles", "component_id", "kept")])
    return _attached(docs, named(docs, doc_id, text, words, percent), doc_id)


def named(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
    among: DataFrame | None = None,
) -> DataFrame:
    """(doc, n_shingles, component_id) per doc_id; with ``among`` (column ``doc``) for these documents only."""
    spark = docs.sparkSession
    if among is not None:
        asked = among.select(F.col("doc").alias(doc_id))
        docs = docs.select(doc_id, text).join(asked, doc_id, "left_semi")
    rows = stored(_sets(docs, doc_id, text, words), "signatures")
    part = rows.where("class IS NOT NULL AND doc IS NOT NULL")
    classes = stored(
        part.groupBy("class").agg(F.min(F.struct("doc", "sig")).alias("x"), F.count(F.lit(1)).alias("n"))
        .select("class", F.col("x.doc").alias("node"), F.col("x.sig").alias("sig")), "classes")
    blocks = stored(exchange.numbered(_blocks(classes)), "blocks")
    n = exchange.buckets_for(spark, classes.count() * M)
    answers = exchange.answer(exchange.ask(blocks, _keys, n))
    postings = stored(_postings(blocks, answers, n), "postings")
    dropped(blocks)
    members = _members(postings)
    dropped(postings)
    wanted = stored(members.select("node").distinct(), "wanted")
    sets = stored(_full_sets(docs, wanted, doc_id, text, words), "sets")
    dropped(wanted)
    links = _links(members, sets, percent)
    dropped(members, sets)
    labels = components(links)
    dropped(links)
    of_class = (
        classes.select("class", "node").join(labels, "node", "left")
        .select("class", F.coalesce("component", "node").alias("component"))
    )
    return rows.join(of_class, "class", "left").groupBy("doc").agg(
        F.max("n_shingles").alias("n_shingles"), F.min(F.coalesce("component", "doc")).alias("component_id")
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """Shingle hashes and signatures of the classes that share a posting."""
    texts = docs.select(F.col(doc_id).alias("node"), F.col(text).alias("text")).join(wanted, "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = encoded(batch.column(1))
            for a, b in slices([len(x) for x in raw], 1 << 19):
                words, off = word_hashes(raw[a:b], lower=True)
                got = [shingles(words[off[i] : off[i + 1]], n) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        pa.array([x.tobytes() for x in got], pa.binary()),
                        pa.array([signature(x).tobytes() for x in got], pa.binary()),
                    ],
                    names=["node", "items", "sig"],
                )

    return texts.mapInArrow(run, "node long, items binary, sig binary")


def _attached(docs: DataFrame, found: DataFrame, doc_id: str) -> DataFrame:
    """Each row of ``docs`` with its document's result; rows without a doc_id are kept."""
    names = docs.columns
    doc = unused("_doc", names)
    found = found.where("doc IS NOT NULL").select(F.col("doc").alias(doc), "n_shingles", "component_id")
    joined = docs.withColumn(doc, F.col(doc_id).cast("long")).join(found, doc, "left")
    return joined.select(
        *names, F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"), F.col("component_id").cast("long").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col(doc), F.lit(True)).alias("kept"),
    )
