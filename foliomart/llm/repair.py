"""Conversation structure repair: cheapest edits by a Viterbi search that runs in parallel chunks.

The turns of a conversation shall have role initials ``(s?(ua)+)?``. A turn is Kept (0), Reroled to user or
assistant (1) or Deleted (2); an empty user or assistant turn may be Inserted anywhere (5). Its first fault
counts: blank (nothing outside ``[\\x20\\x09-\\x0D]``) and duplicate (role and text seen before in the
conversation) turns must be deleted, a truncated turn (last such character not one of ``.!?``) costs 5
unless deleted. Of the cheapest repairs the one with the ASCII-least row of edit initials is taken.

The grammar has four states, so the cost of everything right of a turn is a vector of four numbers, of
which only the differences matter. A turn turns one vector into another, and up to constants there are
but 21 vectors (`VECTORS`). Long conversations are cut into chunks of ``CHUNK`` turns:

1. A chunk starts from every speculative vector at once and walks backwards; walks whose vectors differ
   by a constant only are one from there on, after a few turns mostly all of them.
2. A chunk whose walks have not met yet is fixed up: what its right neighbour leaves takes the place of
   the speculative vectors. Passes rerun until every chunk has one vector; a chunk reaches twice as
   far with each pass, so even turns that change nothing (a conversation of deleted turns only) need
   a logarithm of passes and not one per chunk.
3. The true vectors are stitched to the chunks, the least edit that costs nothing extra leads from each of
   the four entry states to an exit state, entry states are settled the same way, and every chunk is
   traced once from its own.

Turns are ordered by turn (null first), then role, then the digest of the text; repeated rows follow each
other. The sort is by range over all of that, so a conversation may hold any share of the rows and still
lies in many tasks; seen turns are found by sums, not by windows. Null role or text is one space, which
is no initial of the grammar and blank. An empty role cannot be kept. Null ids are one conversation. An
empty table gives empty results; columns other than the four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliomart.llm.stages import dropped, stored
from foliomart.llm.texts import slices

CHUNK = 4096
#: Turns that are Python objects at a time.
TURNS = 50_000
BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")

# states: nothing yet, after a system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state an inserted or reroled turn leads to, and that turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: By role initial (s, u, a, any other): where keeping the turn leads from each state that allows it.
KEEPS = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
ENDS = (START, ASSISTANT)
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5
FAR = 10**6


@cache
def _inserted() -> list[list[int]]:
    """Cost of getting from a state to another by inserts alone."""
    costs = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        at = state
        for k in range(4):
            costs[state][at] = min(costs[state][at], INSERT * k)
            at = NEXT[at]
    return costs


def _moves(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """What can be done with a turn in a state: edit, next state, cost. A symbol is 4 * initial + fault."""
    initial, fault = divmod(symbol, 4)
    yield "D", state, DELETE
    if fault in (NO_FAULT, TRUNCATED):
        extra = CUT if fault == TRUNCATED else 0
        if state in KEEPS[initial]:
            yield "K", KEEPS[initial][state], extra
        yield "R", NEXT[state], REROLE + extra


def _lowered(vector: list[int]) -> tuple[int, ...]:
    least = min(vector)
    return tuple(x - least for x in vector)


@cache
def before(symbol: int, vector: tuple[int, ...]) -> tuple[int, ...]:
    """The vector left of a turn from the one right of it, both with least entry 0."""
    own = [min(cost + vector[to] for _, to, cost in _moves(symbol, state)) for state in range(4)]
    return _lowered([min(c + x for c, x in zip(row, own)) for row in _inserted()])


#: The vector at the end of a conversation: what it costs to end well.
END = _lowered([min(row[q] for q in ENDS) for row in _inserted()])


@cache
def _vectors() -> tuple[tuple[int, ...], ...]:
    found, todo = {END}, [END]
    while todo:
        at = todo.pop()
        new = {before(symbol, at) for symbol in range(16)} - found
        found |= new
        todo += new
    return tuple(sorted(found))


#: All vectors that can occur, up to constants.
VECTORS = _vectors()
NUMBER = {v: i for i, v in enumerate(VECTORS)}


@cache
def edits(symbol: int, state: int, vector: tuple[int, ...]) -> tuple[str, int, int]:
    """The ASCII-least cheapest edits at a turn in a state, given the vector right of it.

    Two characters per edit: D., Iu, Ia, K., Ru or Ra; then the next state and the cost.
    """
    own = [min(cost + vector[to] for _, to, cost in _moves(symbol, q)) for q in range(4)]
    done, paid = "", 0
    while True:
        goal = min(c + x for c, x in zip(_inserted()[state], own))
        moves = {edit: (to, cost) for edit, to, cost in _moves(symbol, state) if cost + vector[to] == goal}
        more = NEXT[state]
        if "D" not in moves and INSERT + min(c + x for c, x in zip(_inserted()[more], own)) == goal:
            done, paid, state = f"{done}I{ROLE_OF[more][0]}", paid + INSERT, more
            continue
        edit = min(moves)
        to, cost = moves[edit]
        return done + edit + (ROLE_OF[to][0] if edit == "R" else "."), to, paid + cost


def closing(state: int) -> tuple[str, int]:
    """The inserts that end a conversation in a state, and their cost."""
    done = ""
    while state not in ENDS:
        state = NEXT[state]
        done += f"I{ROLE_OF[state][0]}"
    return done, INSERT * (len(done) // 2)


def _walk(symbols: list[int], right: int) -> list[tuple[int, ...]]:
    """The vectors right of each turn of a chunk."""
    vector, found = VECTORS[right], []
    for symbol in reversed(symbols):
        found.append(vector)
        vector = before(symbol, vector)
    return found[::-1]


def _speculated(symbols: list[int]) -> list[int]:
    """The vector left of a chunk for every vector right of it."""
    at = {i: v for i, v in enumerate(VECTORS)}
    leads = list(range(len(VECTORS)))
    for symbol in reversed(symbols):
        at = {i: before(symbol, v) for i, v in at.items()}
        first: dict[tuple[int, ...], int] = {}
        merged = {i: first.setdefault(v, i) for i, v in at.items()}
        if len(first) < len(at):
            leads = [merged[i] for i in leads]
            at = {i: v for v, i in first.items()}
    return [NUMBER[at[i]] for i in leads]


def _exits(symbols: list[int], right: int) -> list[int]:
    """The state right of a chunk for every state left of it."""
    states = list(range(4))
    for symbol, vector in zip(symbols, _walk(symbols, right)):
        states = [edits(symbol, q, vector)[1] for q in states]
    return states


def _light(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``TURNS`` turns, so that few are Python objects at a time."""
    for batch in batches:
        sizes = [len(x) for x in batch.column(column)]
        for a, b in slices(sizes, TURNS):
            yield batch.slice(a, b - a)


def _mapped(chunks: DataFrame, columns: list[str], of, link: str) -> DataFrame:
    """(chunk, link, map) with a list of ints per chunk, ``of(*columns)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _light(batches, "symbols"):
            values = [batch.column(2 + i).to_pylist() for i in range(len(columns))]
            made = pa.array([of(*x) for x in zip(*values)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["chunk", "link", "map"])

    return chunks.select("chunk", link, *columns).mapInArrow(run, "chunk long, link long, map array<int>")


def _settled(maps: DataFrame) -> DataFrame:
    """(chunk, value): the value of each chunk's map once nothing depends on what goes in.

    A chunk whose map still has several values takes its linked chunk's map into it and that chunk's link
    over; chunks without a link have one value.
    """
    def checked(frame):
        one = F.array_min("map") == F.array_max("map")
        return frame.select("chunk", F.when(~one, F.col("link")).alias("link"), "map", one.alias("done"))

    now = stored(checked(maps), "chunk-maps")
    while not now.where("NOT done").isEmpty():
        other = now.select(F.col("chunk").alias("link"), F.col("map").alias("first"), F.col("link").alias("beyond"))
        reached = now.where("NOT done").join(other, "link").select(
            "chunk", F.col("beyond").alias("link"), F.expr("transform(first, x -> element_at(map, x + 1))").alias("map")
        )
        last, now = now, stored(checked(reached).unionByName(now.where("done")), "chunk-maps")
        dropped(last)
    return now.select("chunk", F.col("map")[0].alias("value"))


@dataclass
class Repaired:
    """``edits``: a row per edit in order (conversation, row, part), with the repaired role and text, null where
    a turn is deleted. ``summary``: conversation, turns, gaps, blank, duplicate, truncated, illegal, cost."""

    edits: DataFrame
    summary: DataFrame


def _ordered(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    spark = rows.sparkSession
    body = rows.select(
        F.col(conversation).cast("long").alias("conversation"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    )
    body = body.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    body = body.withColumn("copy", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("conversation", "turn", "role", "digest", "copy")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = body.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # partitions are in order, so the number says where a row stands among all
    return dealt.drop("copy").withColumn("row", F.monotonically_increasing_id())


def _symbols(ordered: DataFrame) -> DataFrame:
    said = F.rtrim(F.col("text"), F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    blank = said == ""
    seen = ordered.where(~blank).groupBy("conversation", "role", "digest").agg(F.min("row").alias("row"))
    rows = ordered.select("conversation", "row", initial.alias("initial"), blank.alias("blank"), F.substring(said, -1, 1).isin(*STOPS).alias("ended"))
    met = rows.join(seen.select("row", F.lit(True).alias("first")), "row", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(NO_FAULT)
    return met.select("conversation", "row", (F.col("initial") * 4 + fault).cast("int").alias("symbol"))


def _chunks(symbols: DataFrame, size: int) -> DataFrame:
    """A row per chunk: rows and symbols in order, the neighbours, the last symbol of the one before."""
    steps = F.array_sort(F.collect_list(F.struct("row", "symbol")))
    chunks = symbols.groupBy("conversation", F.expr(f"row div {size}").alias("part")).agg(F.min("row").alias("chunk"), steps.alias("steps"))
    chunks = stored(
        chunks.select("conversation", "chunk", F.col("steps.row").alias("rows"), F.col("steps.symbol").alias("symbols")), "turn-chunks"
    )
    order = W.partitionBy("conversation").orderBy("chunk")
    heads = chunks.select("conversation", "chunk", F.element_at("symbols", -1).alias("last"))
    heads = heads.select(
        "chunk", F.lead("chunk").over(order).alias("next"), F.lag("chunk").over(order).alias("previous"), F.lag("last").over(order).alias("ahead")
    )
    return chunks.join(heads, "chunk")


def _traced(chunks: DataFrame) -> DataFrame:
    """(conversation, row, edits, fault, illegal, cost) per turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _light(batches, "symbols"):
            out: dict[str, list] = {k: [] for k in _TRACED.names}
            for chunk in batch.to_pylist():
                symbols, state, ahead = chunk["symbols"], chunk["entry"], chunk["ahead"]
                for symbol, vector in zip(symbols, _walk(symbols, chunk["right"])):
                    done, state, cost = edits(symbol, state, vector)
                    legal = ahead is None or (ahead // 4, symbol // 4) in ((0, 1), (1, 2), (2, 1))
                    for k, v in (("edits", done), ("fault", symbol % 4), ("illegal", not legal), ("cost", cost)):
                        out[k].append(v)
                    ahead = symbol
                if chunk["next"] is None:
                    done, cost = closing(state)
                    out["edits"][-1] += done
                    out["cost"][-1] += cost
                out["conversation"] += [chunk["conversation"]] * len(symbols)
                out["row"] += chunk["rows"]
            yield pa.RecordBatch.from_pydict(out, _TRACED)

    needed = chunks.select("conversation", "rows", "symbols", "next", "ahead", "right", "entry")
    return needed.mapInArrow(run, "conversation long, row long, edits string, fault int, illegal boolean, cost long")


_TRACED = pa.schema(
    [
        ("conversation", pa.int64()), ("row", pa.int64()), ("edits", pa.string()), ("fault", pa.int32()),
        ("illegal", pa.bool_()), ("cost", pa.int64()),
    ]
)


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK
) -> Repaired:
    """The cheapest repair of every conversation."""
    ordered = stored(_ordered(rows, conversation, turn, role, text), "ordered-turns")
    chunks = stored(_chunks(_symbols(ordered), chunk), "linked-chunks")
    parts = chunks.where("next IS NOT NULL OR previous IS NOT NULL")
    end = NUMBER[END]
    left = _settled(
        _mapped(parts, ["symbols", "next"], lambda s, n: _speculated(s) if n is not None else [NUMBER[before(s[0], _walk(s, end)[0])]] * len(VECTORS), "next")
    )
    right = left.select(F.col("chunk").alias("next"), F.col("value").alias("right"))
    chunks = stored(chunks.join(right, "next", "left").withColumn("right", F.coalesce("right", F.lit(end))), "stitched-chunks")
    parts = chunks.where("next IS NOT NULL OR previous IS NOT NULL")
    exits = _settled(
        _mapped(parts, ["symbols", "right", "previous"], lambda s, r, p: _exits(s, r) if p is not None else [_exits(s, r)[START]] * 4, "previous")
    )
    entry = exits.select(F.col("chunk").alias("previous"), F.col("value").alias("entry"))
    chunks = chunks.join(entry, "previous", "left").withColumn("entry", F.coalesce("entry", F.lit(START)))
    traced = stored(_traced(chunks), "traced-turns")
    return Repaired(_applied(ordered, traced), _summed(ordered, traced))


def _applied(ordered: DataFrame, traced: DataFrame) -> DataFrame:
    done = ordered.select("row", "role", "text").join(traced.select("conversation", "row", "edits"), "row")
    each = F.posexplode(F.expr("transform(sequence(1, length(edits), 2), i -> substring(edits, i, 2))")).alias("part", "what")
    done = done.select("conversation", "row", "role", "text", each)
    edit, given = F.substring("what", 1, 1), F.when(F.substring("what", 2, 1) == "u", "user").otherwise("assistant")
    return done.select(
        "conversation", "row", "part", edit.alias("edit"),
        F.when(edit == "K", F.col("role")).when(edit != "D", given).alias("role"),
        F.when(edit == "I", "").when(edit != "D", F.col("text")).alias("text"),
    )


def _summed(ordered: DataFrame, traced: DataFrame) -> DataFrame:
    days = ordered.groupBy("conversation", "turn").count()
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    spans = days.groupBy("conversation").agg(F.sum("count").alias("turns"), span.alias("gaps"))
    counts = traced.groupBy("conversation").agg(
        *[F.count_if(F.col("fault") == f).alias(name) for f, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
        F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"),
    )
    return _beside(spans, counts)


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on conversation, null meeting null."""
    other = right.withColumnRenamed("conversation", "_of")
    return left.join(other, F.col("conversation").eqNullSafe(F.col("_of")), "left").drop("_of")


class _Digest:
    def __init__(self, who: int | None):
        self.who, self.audit, self.sha, self.lines = who, bytearray(), hashlib.sha256(), 0

    def add(self, edit: str, role: str | None, text: str | None) -> None:
        self.audit += edit.encode()
        if edit != "D":
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1


def digests(edits_: DataFrame) -> DataFrame:
    """(conversation, audit, repaired_sha256): edits and repaired turns, streamed in order through one hash each."""
    n = int(edits_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edits_.repartition(n, "conversation").sortWithinPartitions("conversation", "row", "part")
    schema = pa.schema([("conversation", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def packed():
            return pa.RecordBatch.from_pylist(
                [{"conversation": d.who, "audit": d.audit.decode(), "repaired_sha256": d.sha.hexdigest()} for d in done], schema
            )

        for batch in batches:
            for who, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now is None or who != now.who:
                    now = _Digest(who)
                    done.append(now)
                now.add(edit, role, text)
            if len(done) > 1000:
                last = done.pop()
                yield packed()
                done = [last]
        if done:
            yield packed()

    return dealt.select("conversation", "edit", "role", "text").mapInArrow(run, "conversation long, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with faults dealt by crc32 of ``conv_id:turn``; nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    ).where("times > 0")
    return rows.withColumn("times", F.explode(F.expr("sequence(1, times)"))).drop("times")


def report(rows: DataFrame, of: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per conversation of ``of`` with what was found in ``rows``, and audit and digest of the repair."""
    found = repair(rows, chunk=chunk)
    every = of.select(F.col("conv_id").cast("long").alias("conversation")).distinct()
    joined = _beside(_beside(every, found.summary), digests(found.edits))
    numbers: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("conversation").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
