"""JSON records of mixed layouts: kinds come from the JSON, nothing is lost, every layout of the query maps back."""

import json

import pytest

from isobar.llm import chat, queries

TEXTS = ["plain", "", "[", "{}", "[]", '{"x": 1}', '[{"a":1}]', '"quoted"', "null", "12", "a\nb\x00 é😀 ` ``: STRING, > OBJECT<", "### Assistant: </turn>"]


def records(spark, given):
    return spark.createDataFrame([(k, None if v is None else v if isinstance(v, str) else json.dumps(v)) for k, v in given.items()], "conv_id long, record string")


@pytest.mark.parametrize("text", TEXTS)
def test_texts_that_look_like_json_stay_texts(spark, text):
    given = {
        1: {"prompt": text, "response": "ok"}, 2: {"prompt": "hi", "response": text}, 3: {"messages": [{"role": "user", "content": text}, {"role": "x", "content": "b"}]},
        4: {"conversations": [{"from": "human", "value": text}, {"from": "gpt", "value": text}]}, 5: {"turn": 3, "role": "user", "text": text}, 6: {"system": text, "prompt": "p", "response": "r"},
        7: {"question": text, "answer": "a", "source": "more fields"}, 8: {"instruction": text, "input": "", "output": text}, 9: {"prompt": text, "completion": "c"}, 10: {"instruction": "i", "output": text},
    }
    want = {
        (1, 0, "user", text), (1, 1, "assistant", "ok"), (2, 0, "user", "hi"), (2, 1, "assistant", text), (3, 0, "user", text), (3, 1, "x", "b"), (4, 0, "user", text), (4, 1, "assistant", text), (5, 3, "user", text),
        (6, 0, "system", text), (6, 1, "user", "p"), (6, 2, "assistant", "r"), (7, 0, "user", text), (7, 1, "assistant", "a"), (8, 0, "user", text), (8, 1, "assistant", text), (9, 0, "user", text), (9, 1, "assistant", "c"),
        (10, 0, "user", "i"), (10, 1, "assistant", text),
    }
    df = records(spark, given)
    assert set(map(tuple, chat.turns_of_json(df).collect())) == want
    assert chat.unmapped_records(df).collect() == []


def test_every_record_has_turns_or_is_listed(spark):
    given = {
        1: {"prompt": 7, "response": None}, 2: {"other": {"deep": [{"a": [1, {"b c": 2}]}]}}, 3: {"messages": []}, 4: "no json", 5: None, 6: "[1, 2]", 7: '"text"', 8: {}, 9: {"prompt": {"parts": ["a"]}, "response": "r"},
        10: {"messages": [{"role": "user", "content": [{"type": "text"}]}]}, 11: {"messages": [{"role": "user", "content": None}, {"role": None}]}, 12: {"a.b": {"`c`": 1}}, 13: "", 14: {"messages": [{"role": "user", "content": "a", "name": "n"}]},
    }
    df = records(spark, given)
    turns = sorted(map(tuple, chat.turns_of_json(df).collect()))
    assert turns == [(1, 0, "user", "7"), (1, 1, "assistant", ""), (11, 0, "user", ""), (11, 1, "", ""), (14, 0, "user", "a")]
    listed = {r.conv_id: r.paths for r in chat.unmapped_records(df).collect()}
    assert {t[0] for t in turns} | set(listed) == set(given)
    assert listed[2] == ["other.deep[].a[]"] or listed[2] == ["other.deep[].a[]", "other.deep[].a[].b c"]
    assert listed[9] == ["prompt.parts[]", "response"] and listed[10] == ["messages[].content[].type", "messages[].role"] and listed[12] == ["a.b.`c`"] and listed[4] is None and listed[5] is None


def test_paths_agree_with_those_of_schemas(spark):
    df = spark.sql("select 1 as a, named_struct('x', array(named_struct('y', 'z', 'w', array(1))), 'v', true) as b")
    made = df.selectExpr("1L as conv_id", "to_json(struct(*)) as record")
    assert chat.mapped_records(made).first()["paths"] == sorted(chat.field_paths(df.schema))


def test_query_goes_through_several_layouts(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet")
    extra = [(90, 0, "human", "{}"), (90, 1, "assistant", "[1]"), (91, 0, "user", "[{"), (91, 1, "assistant", '{"a": 1}'), (None, 0, "user", "no id"), (92, 0, None, None), (92, 0, None, None), (93, 0, "user", "x" * 1_100_000), (94, 2, "assistant", "b"), (94, 1, "user", "{"), (94, 1, "tool", "[]")]
    given = rows.unionByName(spark.createDataFrame(extra, rows.schema))
    made, own = chat.as_records(given)
    mapped = chat.mapped_records(made)
    assert {r.layout for r in mapped.select("layout").distinct().collect()} == {0, 1, 2, 4}
    back = chat.turns_of_json(made).unionByName(chat.canonical_turns(own)).collect()
    texts = {}
    for r in sorted(back, key=lambda r: (str(r.conv_id), r.turn)):
        texts.setdefault(r.conv_id, []).append((r.role, r.text))
    want = {}
    for r in sorted(given.collect(), key=lambda r: (str(r.conv_id), r.turn, r.role or "", r.text or "")):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    assert texts == want
    assert queries.op7_chat(spark, data).count() == rows.select("conv_id").distinct().count() + 1


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made, own = chat.as_records(rows)
    assert made.collect() == own.collect() == chat.turns_of_json(made).collect() == chat.unmapped_records(made).collect() == []
    parts = chat.formatted_turns(rows)
    assert parts.collect() == [] and chat.read_back(chat.conversations(parts)).collect() == []
