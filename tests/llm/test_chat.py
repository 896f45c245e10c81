import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliomart.llm import chat

TEXT = st.text(st.sampled_from("\\#<>/:turn assistant### \n\x0bé𝄞"), max_size=30)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    text = "".join(chat.segment(r, t)[0] for r, t in turns)
    assert chat.read_segments(text) == turns
    for r, t in turns:
        whole, a, b = chat.segment(r, t)
        assert chat.unescaped(whole[a:b]) == t


def test_text_that_is_not_formatted_is_refused():
    with pytest.raises(ValueError):
        chat.read_segments("### user: hi")


@pytest.mark.parametrize(
    "record, turns",
    [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, [("user", "a"), ("assistant", "")]),
        ({"data": {"dialog": [{"speaker": "bot", "utterance": "x"}]}}, [("assistant", "x")]),
        ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
        ({"instruction": "do", "input": "with", "output": "done"}, [("user", "do"), ("user", "with"), ("assistant", "done")]),
        ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
        ({"role": "system", "text": None}, [("system", "")]),
    ],
)
def test_layouts(record, turns):
    assert chat.canonical(record)[1] == turns
    assert chat.canonical(dict(reversed(record.items())))[1] == turns  # the order of fields does not matter


def test_unknown_layouts_are_kept_apart(spark):
    records = [(1, 0, json.dumps({"question": "?", "answer": "!"})), (2, 0, json.dumps({"prompt": "p", "response": "r"})), (3, 0, None)]
    made = chat.turns(spark.createDataFrame(records, "c long, t long, record string"), "c", "t").collect()
    assert sorted((r["conversation"], r["part"], r["layout"], r["role"]) for r in made if r["layout"]) == [
        (2, 0, "prompt/response", "user"), (2, 1, "prompt/response", "assistant")
    ]
    assert sorted(r["conversation"] for r in made if r["layout"] is None) == [1, 3]


def plain(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == c), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        said = "".join(x for _, r, x in own if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        out[c] = (len(own), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def digests(df):
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record")
    return chat.digests(chat.formatted(chat.turns(df.select("conv_id", "turn", record), "conv_id", "turn")))


SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_conversations_with_every_odd_case(spark):
    nasty = "\\### Assistant: </turn> ok\n### user: \\"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (2, 3, None, None), (2, None, "assistant", ""),
            (None, 0, "assistant", "x"), (3, 0, "a:b#c<d", "t"), (4, 0, "user", "long " * 60_000)]
    rows += [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "?") for r in rows], SCHEMA).repartition(5)
    found = {r["conv_id"]: tuple(r)[1:5] for r in digests(df).collect()}
    assert found == plain(rows)


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], SCHEMA)).count() == 0
