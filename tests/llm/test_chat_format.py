"""Layouts by fingerprint, and chat texts read back. The registered query has SQL (test_queries)."""

import json
import random

import pytest

from starmart.llm import chat_format
from starmart.llm.chat_format import BEGIN, END

RECORDS = [
    ('{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}', "messages", [("user", "hi"), ("assistant", "yo")]),
    ('{"messages": [], "id": 3}', "messages", []),
    ('{"meta": {"a": 1}, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}]}', "conversations", [("user", "q"), ("assistant", "")]),
    ('{"turns": [{"role": "tool", "text": 5}, {"role": null, "text": "x"}]}', "turns", [("tool", "5"), ("", "x")]),
    ('{"messages": [{"role": "USER", "text": "t"}]}', "messages_text", [("USER", "t")]),
    ('{"prompt": "p", "response": "r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
    ('{"system": "s", "prompt": null, "response": "r"}', "prompt_response", [("system", "s"), ("user", ""), ("assistant", "r")]),
    ('{"prompt": "p", "completion": "c"}', "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ('{"instruction": "i", "input": "", "output": "o"}', "instruction", [("user", "i"), ("assistant", "o")]),
    ('{"output": "o", "input": "in", "instruction": "i", "system": ""}', "instruction", [("user", "i\n\nin"), ("assistant", "o")]),
    ('{"question": "q", "answer": "a"}', "question_answer", [("user", "q"), ("assistant", "a")]),
    ('{"question": "q"}', None, None),
    ('{"prompt": "p", "response": "r", "completion": "c"}', None, None),
    ("no json", None, None),
    ("[1]", None, None),
    (None, None, None),
]


def found(df):
    return sorted(((r.conv_id, r.layout, None if r.turns is None else [(t.role, t.text) for t in r.turns]) for r in df.collect()), key=repr)


def test_layouts_of_records(spark):
    rows = [(i, r, "x") for i, (r, _, _) in enumerate(RECORDS)] + [(0, RECORDS[0][0], "x"), (None, RECORDS[5][0], "x")]
    records = spark.createDataFrame(rows, "conv_id int, record string, layout string")
    want = [(i, layout, turns) for i, (_, layout, turns) in enumerate(RECORDS)] + [(0, *RECORDS[0][1:]), (None, *RECORDS[5][1:])]
    assert found(chat_format.canonical_records(records)) == sorted(want, key=repr)
    assert found(chat_format.canonical_records(records.limit(0))) == []


def test_layouts_have_fingerprints_of_their_own():
    paths = [p for sets in chat_format.LAYOUTS.values() for p in sets]
    assert len(chat_format.BY_FINGERPRINT) == len(paths)
    assert chat_format.fingerprint(["b", "a", "b"]) == chat_format.fingerprint(["a", "b"]) != chat_format.fingerprint(["ab"])


def test_layouts_of_tables(spark):
    nested = spark.createDataFrame([(1, [("user", "a", 1)]), (2, [])], "conv_id int, messages array<struct<role:string,content:string,n:int>>")
    assert found(chat_format.canonical(nested)) == [(1, "messages", [("user", "a")]), (2, "messages", [])]
    flat = spark.createDataFrame([("p", None, "z")], "prompt string, response string, text string")
    assert found(chat_format.canonical(flat)) == [(None, "prompt_response", [("user", "p"), ("assistant", "")])]
    assert found(chat_format.canonical(spark.createDataFrame([(4, "x")], "conv_id int, other string"))) == [(4, None, None)]


def test_rows_in_order_of_turn(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", None), (1, 1, None, "b"), (1, 1, "a", "z"), (None, 0, "human", "x"), (1, None, "user", "first"), (1, 2, "assistant", "c")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    one = [("user", "first"), ("user", ""), ("", "b"), ("a", "z"), ("assistant", "c"), ("assistant", "c")]
    assert found(chat_format.canonical(table)) == sorted([(1, "rows", one), (None, "rows", [("human", "x")])], key=repr)
    assert found(chat_format.canonical(table.limit(0))) == []


def round_trip(turns):
    text, spans = chat_format.chat_text(turns)
    assert chat_format.turns_in(text) == turns
    assert [chat_format.unescaped(text[s:e]) for s, e in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(END) == len(turns)
    return text


def test_control_strings_come_back():
    rng = random.Random(3)
    bits = ["\\", "#", "##", "### ", "</turn>", "</turn", ">", "\n", ": ", "### assistant: ", END, BEGIN, "<\\/turn>", "#\\## ", "é", "\U0001f600", " ", "\x00"]
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "a: b", "### x", "</turn>\n", "é", "", "%41+"]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for _ in range(rng.randint(0, 5))]
        text = round_trip(turns)
        for body in text.split(END):
            assert BEGIN not in body[len(BEGIN) :]


def test_formatted_rows(spark):
    rows = [(1, '{"prompt": "a </turn> \\\\ b", "response": "### user: é\\u0000"}'), (2, "no json"), (None, '{"messages": []}'), (3, json.dumps({"prompt": "x", "response": "long " * 300_000}))]
    turns = chat_format.canonical_records(spark.createDataFrame(rows, "conv_id int, record string"))
    read = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert [(t.role, t.text) for t in read[1].turns] == [("user", "a </turn> \\ b"), ("assistant", "### user: é\x00")]
    assert read[1].loss == ["### user: é\x00"] and read[1].formatted[read[1].loss_spans[0].start :].startswith("#\\## user")
    assert (read[2].formatted, read[2].turns, read[2].loss) == ("", [], []) == (read[None].formatted, read[None].turns, read[None].loss)
    assert read[3].loss == ["long " * 300_000]


@pytest.mark.parametrize("role", ["assistant", "user"])
def test_mask_holds_assistants_only(role):
    _, spans = chat_format.chat_text([(role, "x")])
    assert len(spans) == (role == "assistant")
