import json

import pytest

from changeloom.llm import chat, queries

SCHEMAS = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}
CALL = "conv_id long, turn long, call_id string, name string, arguments string, after string, depth string"
RESULT = "conv_id long, turn long, call_id string, content string"


def records(spark, calls, results):
    calls = spark.createDataFrame([(*c, "x") for c in calls], CALL)
    return chat.tool_calls(calls, spark.createDataFrame(results, RESULT), SCHEMAS).collect()


def test_linking_order_and_checks(spark):
    ok = '{"a": 1}'
    calls = [
        (1, 4, "c", "add", ok, "b"),
        (1, 0, "a", "add", '{ "a" : 7 }', None),
        (1, 2, "b", "add", ok, "a"),
        (1, 6, "d", "add", '{"a": -1}', "unknown"),
        (1, 8, "e", "add", "{broken", None),
        (1, 9, "f", "sub", ok, None),
        (1, 10, None, "add", ok, None),
        (1, 11, "a", "add", ok, None),
        (1, 12, "g", "add", None, "h"),
        (1, 13, "h", "add", ok, "g"),
        (1, 14, "i", "add", ok, "h"),
        (1, 15, "j", "add", '{"a": 1, "z": NaN}', None),
        (2, 0, "a", "add", ok, None),
        (2, 0, "a", "add", ok, None),
        (None, 0, "a", "add", ok, None),
    ]
    results = [(1, 1, "a", "7 é"), (1, 3, "b", "ok"), (1, 5, "c", None), (1, 5, "x", "lost"), (1, 1, None, "?"), (1, 20, "a", "more"), (1, 7, "h", "early")]
    rows = records(spark, calls, results)
    by = {(r["conv_id"], r["turn"], r["call_id"]): r for r in rows}
    assert len(by) == len(rows) == len(calls) - 1 + 3
    status = {k: r["status"] for k, r in by.items()}
    assert status[1, 0, "a"] == status[1, 2, "b"] == status[1, 4, "c"] == "linked"
    assert status[1, 11, "a"] == "repeated" and status[1, 20, "a"] == "repeated result" and status[1, 10, None] == "without identifier"
    assert status[1, 5, "x"] == status[1, 1, None] == "result without call" and status[1, 13, "h"] == "result before call"
    assert status[2, 0, "a"] == "without result" and by[2, 0, "a"]["copies"] == 2
    assert [by[1, t, c]["depth"] for t, c in ((0, "a"), (2, "b"), (4, "c"), (6, "d"))] == [0, 1, 2, 0]
    assert [by[1, t, c]["depth"] for t, c in ((12, "g"), (13, "h"), (14, "i"))] == [None] * 3
    assert by[1, 0, "a"]["valid"] and by[1, 0, "a"]["json"] == '{"after":null,"arguments":{"a":7},"call_id":"a","name":"add","result":"7 é","status":"linked"}'
    problems = {c: by[1, t, c]["problem"] for t, c in ((6, "d"), (8, "e"), (9, "f"), (12, "g"), (15, "j"))}
    assert problems == {"d": "$.a: minimum", "e": "arguments are not JSON", "f": "no schema for sub", "g": "$: not object", "j": "arguments are not JSON"}
    for r in rows:
        assert chat.canonical(json.loads(r["json"])) == r["json"]


def test_depth_follows_long_chains(spark):
    calls = [(1, k, f"c{k}", "add", "{}", f"c{k - 1}") for k in range(70)]
    assert {r["turn"]: r["depth"] for r in records(spark, calls, [])} == {k: k for k in range(70)}


def test_empty_tables(spark):
    assert records(spark, [], []) == []


def test_schema_checks():
    schema = {"type": "object", "properties": {"l": {"type": "array", "items": {"type": "string", "maxLength": 2}}, "e": {"enum": [1, "x"]}}}
    assert chat.violation({"l": ["ab"], "e": 1, "other": 0}, schema) is None
    assert chat.violation({"l": ["ab", "abc"]}, schema) == "$.l[1]: maxLength"
    assert chat.violation({"e": 2}, schema) == "$.e: not allowed"
    assert chat.violation([], schema) == "$: not object"
    assert chat.violation(True, {"type": "integer"}) == "$: not integer"


def test_turns_of_conversations(spark):
    turns = [(1, 0, "user", 'say "hi"\n'), (1, 1, "assistant", "hi"), (1, 2, "user", ""), (1, 3, "tool", "x"), (2, 5, "assistant", "alone"), (1, 4, None, None), (3, 0, "user", None)]
    calls, results = chat.conversation_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = {(r["conv_id"], r["turn"]): r for r in chat.tool_calls(calls, results, {"ask": chat.ASK}).collect()}
    assert rows[1, 0]["valid"] and json.loads(rows[1, 0]["json"])["arguments"] == {"question": 'say "hi"\n', "turn": 0, "words": 2}
    assert rows[1, 2]["problem"] == "$.question: minLength" and rows[1, 2]["depth"] == 1
    assert rows[2, 5]["status"] == "result without call" and rows[3, 0]["problem"] == "$.question: missing"


def test_every_turn_has_a_record(spark, tmp_path):
    turns = [(1, 0, "system", 'be "kind"\n'), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "tool", None), (1, 4, None, "x"), (2, 0, "system", "s"), (2, 0, "system", "s"), (None, 0, "system", "")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = queries.op10_chat(spark, str(tmp_path)).collect()
    by = {(r["conv_id"], r["turn"]): r for r in rows}
    assert len(rows) == len(by) == 6 and sorted(r["status"] for r in rows) == ["linked"] + ["no call"] * 5
    assert json.loads(by[1, 1]["json"])["result"] == "hello"
    for conv, turn, role, text in turns:
        if role not in ("user", "assistant"):
            r = by[conv, turn]
            assert r["json"] == chat.canonical({"role": role, "status": "no call", "text": text})
            assert (r["depth"], r["call_id"], r["valid"], r["problem"]) == (None, None, False, None)
    assert by[2, 0]["copies"] == 2


def test_turns_of_given_conversations_are_all_there(spark):
    sf = "/root/testdata/sf0.1"
    told = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = queries.op10_chat(spark, sf).collect()
    others = told.filter("role IS NULL OR role NOT IN ('user', 'assistant')").count()
    assert others > 0 and sum(r["copies"] for r in rows if r["status"] == "no call") == others


def test_valid_json_of_any_kind_is_no_crash(spark):
    deep = "[" * 100_000 + "]" * 100_000
    texts = ['{"a":"\\ud800"}', deep, '{"a":' * 300 + "1" + "}" * 300, "[[[1]]]", '"' + "x" * 2_000_000 + '"', "", "nul"]
    rows = {r["turn"]: r for r in records(spark, [(1, k, f"c{k}", "add", t, None) for k, t in enumerate(texts)], [])}
    assert rows[0]["problem"] == "$.a: not integer" and '"\\ud800"' in rows[0]["json"]
    assert [rows[k]["problem"] for k in (1, 2, 5, 6)] == ["arguments are not JSON"] * 4
    assert rows[3]["problem"] == rows[4]["problem"] == "$: not object" and len(rows[4]["json"]) > 2_000_000
    for row in rows.values():
        json.loads(row["json"])


def test_calls_without_conversation_stand_alone(spark):
    calls = [(None, 0, "a", "add", '{"a":1}', None), (None, 1, "a", "add", '{"a":2}', None), (1, 0, "a", "add", '{"a":1}', None)]
    got = sorted((r["conv_id"] or 0, r["turn"], r["status"]) for r in records(spark, calls, [(None, 2, "a", "x"), (None, 3, "a", "y"), (1, 1, "a", "z")]))
    assert got == [
        (0, 0, "without result"), (0, 1, "without result"), (0, 2, "result without call"), (0, 3, "result without call"), (1, 0, "linked")
    ]


def test_schemas_are_checked_or_refused(spark):
    schema = {
        "type": ["object", "null"],
        "properties": {
            "a": {"anyOf": [{"type": "integer", "minimum": 3}, {"const": "none"}]},
            "b": {"type": "string", "pattern": "^x+$"},
            "c": {"type": "array", "minItems": 1, "items": {"enum": [1, "1"]}},
            "d": {"allOf": [{"type": "string"}, {"maxLength": 2}]},
        },
    }
    chat.check_schema(schema)
    fine = [None, {}, {"a": 3}, {"a": "none"}, {"b": "xx"}, {"c": [1, "1"]}, {"d": "ab"}]
    assert [chat.violation(v, schema) for v in fine] == [None] * len(fine)
    wrong = [([], "$: not object or null"), ({"a": 2}, "$.a: anyOf"), ({"a": True}, "$.a: anyOf"), ({"b": "y"}, "$.b: pattern"), ({"c": []}, "$.c: minItems")]
    wrong += [({"c": [True]}, "$.c[0]: not allowed"), ({"d": "abc"}, "$.d: maxLength"), ({"d": 1}, "$.d: not string")]
    assert [chat.violation(v, schema) for v, _ in wrong] == [p for _, p in wrong]
    for bad in ({"$ref": "#/x"}, {"properties": {"a": {"oneOf": []}}}, {"type": "text"}, {"type": ["null", "date"]}, {"items": [{}]}):
        with pytest.raises(ValueError):
            chat.check_schema(bad)
    empty = spark.createDataFrame([], CALL)
    with pytest.raises(ValueError, match="oneOf"):
        chat.tool_calls(empty, spark.createDataFrame([], RESULT), {"f": {"oneOf": []}})
