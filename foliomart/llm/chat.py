"""Chat formatting: records of any known layout become canonical turns, then text with a loss mask.

The layout of a record is known by the hash of its nested field paths (names only; elements of a list
share one path). Each fingerprint selects a declarative mapping: where turns are, and where their roles
and texts are. A record whose fingerprint has no mapping gives one row with ``layout`` null, so it can
be looked at and nothing is lost silently.

Text is ``### Role: text</turn>`` per turn. Backslash, ``#`` and ``<`` (and ``:`` in roles) inside texts
are escaped with a backslash, so a control string inside a text is never one, and reading back gives
the same turns. The loss mask covers the assistant's texts.

A conversation's rows are sorted inside its partition and streamed: nothing holds a whole
conversation, however long. Null text or role is empty; null conversation ids are one conversation;
a null turn comes first; equal turns are ordered by role and text; repeated rows are turns of their
own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Mapping:
    """``turns``: path of a list of turns with the fields ``role`` and ``text``; or ``fixed``: (role, path)
    pairs in order. A dot goes into a field. Empty fixed fields are left out."""

    name: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fixed: tuple[tuple[str, str], ...] = ()
    whole: bool = False  # the record itself is one turn


def paths(value, at: str = "") -> set[str]:
    """The nested field paths of a record; list elements add ``[]``."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at}
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


#: Known layouts: their field paths and how to read them.
LAYOUTS: list[tuple[set[str], Mapping]] = [
    ({"role", "text"}, Mapping("turn rows", whole=True, text="text")),
    ({"role", "content"}, Mapping("message rows", whole=True)),
    ({"messages[].role", "messages[].content"}, Mapping("messages", turns="messages")),
    ({"conversations[].from", "conversations[].value"}, Mapping("from/value", turns="conversations", role="from", text="value")),
    ({"data.dialog[].speaker", "data.dialog[].utterance"}, Mapping("dialog", turns="data.dialog", role="speaker", text="utterance")),
    ({"prompt", "response"}, Mapping("prompt/response", fixed=(("user", "prompt"), ("assistant", "response")))),
    ({"prompt", "completion"}, Mapping("prompt/completion", fixed=(("user", "prompt"), ("assistant", "completion")))),
    ({"system", "prompt", "response"}, Mapping("system prompt", fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response")))),
    ({"instruction", "output"}, Mapping("instruction", fixed=(("user", "instruction"), ("assistant", "output")))),
    (
        {"instruction", "input", "output"},
        Mapping("instruction with input", fixed=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    ),
]
BY_FINGERPRINT = {fingerprint(found): mapping for found, mapping in LAYOUTS}


def _get(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: dict) -> tuple[str | None, list[tuple[str, str]]]:
    """The layout's name and the turns of a record."""
    mapping = BY_FINGERPRINT.get(fingerprint(paths(record)))
    if mapping is None:
        return None, []
    if mapping.whole:
        return mapping.name, [(_text(_get(record, mapping.role)), _text(_get(record, mapping.text)))]
    if mapping.turns:
        turns = _get(record, mapping.turns) or []
        found = [(_text(_get(t, mapping.role)), _text(_get(t, mapping.text))) for t in turns]
        return mapping.name, [(ALIASES.get(r, r), t) for r, t in found]
    return mapping.name, [(r, _text(_get(record, p))) for r, p in mapping.fixed if _get(record, p) not in (None, "")]


def turns(records: DataFrame, conversation: str, order: str, body: str = "record") -> DataFrame:
    """(conversation, turn, part, role, text, layout) of records given as JSON texts in ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in _TURN.names}
            for who, when, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                layout, found = canonical(json.loads(raw)) if raw is not None else (None, [])
                for part, (role, text) in enumerate(found or [(None, None)]):
                    for k, v in zip(_TURN.names, (who, when, part, role, text, layout)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, _TURN)

    return records.select(
        F.col(conversation).cast("long"), F.col(order).cast("long"), F.col(body)
    ).mapInArrow(run, "conversation long, turn long, part int, role string, text string, layout string")


_TURN = pa.schema(
    [
        ("conversation", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("role", pa.string()),
        ("text", pa.string()), ("layout", pa.string()),
    ]
)

_ESCAPED = re.compile(r"[\\#<]")
_ROLE_ESCAPED = re.compile(r"[\\#<:]")
_READ = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)


def escaped(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and where its text stands in it."""
    head = f"### {_ROLE_ESCAPED.sub(r'\\\g<0>', role)}: "
    body = escaped(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def read_segments(formatted: str) -> list[tuple[str, str]]:
    """The turns of formatted text; anything else raises an error."""
    at, found = 0, []
    for match in _READ.finditer(formatted):
        if match.start() != at:
            break
        found.append((unescaped(match[1]), unescaped(match[2])))
        at = match.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at character {at}")
    return found


def formatted(canonical_turns: DataFrame) -> DataFrame:
    """(conversation, seq, formatted, loss_start, loss_end): the text of each turn in order.

    A conversation's text is its turns' texts one after another. The loss span is in characters of the
    turn's text and null where nothing is learnt.
    """
    rows = canonical_turns.where("layout IS NOT NULL")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "conversation").sortWithinPartitions("conversation", "turn", "part", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seq = object(), 0
        for batch in batches:
            out = {k: [] for k in _SEGMENT.names}
            for row in batch.to_pylist():
                seq = seq + 1 if row["conversation"] == current else 0
                current = row["conversation"]
                text, a, b = segment(row["role"], row["text"])
                learnt = row["role"] == "assistant"
                for k, v in zip(_SEGMENT.names, (current, seq, text, a if learnt else None, b if learnt else None)):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, _SEGMENT)

    return rows.mapInArrow(run, "conversation long, seq long, formatted string, loss_start long, loss_end long")


_SEGMENT = pa.schema(
    [
        ("conversation", pa.int64()), ("seq", pa.int64()), ("formatted", pa.string()),
        ("loss_start", pa.int64()), ("loss_end", pa.int64()),
    ]
)


class _Digest:
    def __init__(self, who):
        self.who, self.turns, self.chars, self.loss_chars = who, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, a: int | None, b: int | None) -> None:
        for role, said in read_segments(text):
            self.turns += 1
            self.all.update(f"{role}\n{said}\n".encode())
        self.chars += len(text)
        if a is not None:
            learnt = unescaped(text[a:b])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.who, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }


def digests(segments: DataFrame) -> DataFrame:
    """Read formatted conversations back: one row each. Rows come as `formatted` leaves them."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conversation"] != now.who:
                    done += [now.row()] if now else []
                    now = _Digest(row["conversation"])
                now.add(row["formatted"], row["loss_start"], row["loss_end"])
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, _DIGEST)
                done = []
        done += [now.row()] if now else []
        if done:
            yield pa.RecordBatch.from_pylist(done, _DIGEST)

    return segments.mapInArrow(run, schema)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)
