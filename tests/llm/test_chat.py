from __future__ import annotations

import json

from tillwright.llm import chat

CALL = "conv_id bigint, call_id string, turn bigint, name string, arguments string"
RESULT = "conv_id bigint, call_id string, turn bigint, content string"


def _linked(spark, calls, results):
    found = chat.linked(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT), chat.TOOLS)
    return {(r["conv_id"], r["call_id"], r["turn"]): r for r in found.collect()}


def test_links_order_validation_and_json(spark):
    calls = [
        (1, "a", 0, "lookup", '{ "strict" : true, "key": "k\\n\\"é" }'),
        (1, "b", 2, "search", '{"query": "q", "limit": 5, "after": ["a"]}'),
        (1, "c", 1, "note", '{"text": "t", "after": ["b", "a"]}'),
        (2, "a", 0, "search", '{"query": 3, "limit": 99, "extra": null}'),
        (2, "x", 1, "note", '{"text":"t","after":["y"]}'),
        (2, "y", 2, "note", '{"text":"t","after":["x"]}'),
        (2, "z", 3, "note", '{"text":"t","after":["y"]}'),
        (2, "u", 4, "note", '{"text":"t","after":["nowhere"]}'),
        (3, "d", 0, "note", '{"text":"t"}'),
        (3, "d", 0, "note", '{"text":"t"}'),
        (3, "d", 5, "note", '{"text":"later"}'),
        (3, None, 6, "note", '{"text":"t"}'),
        (3, "e", 7, "nothing", "{}"),
        (3, "f", 8, "note", None),
        (3, "g", 9, "note", "[1]"),
        (3, "h", 10, None, "not json"),
        (None, "i", 11, "note", '{"text":""}'),
    ]
    results = [(1, "a", 1, "r1"), (1, "a", 9, "r9"), (1, "b", 3, None), (1, "c", 3, ""), (3, "d", 1, "x"), (4, "o", 1, "lost"), (None, "i", 12, "n")]
    found = _linked(spark, calls, results)
    assert len(found) == 17
    errors = {k[:2] + k[2:]: r["errors"] for k, r in found.items()}
    assert errors[(1, "a", 0)] == errors[(1, "c", 1)] == errors[(3, "d", 0)] == errors[(None, "i", 11)] == ""
    assert [found[(1, k, t)]["level"] for k, t in (("a", 0), ("b", 2), ("c", 1))] == [0, 1, 2]
    assert errors[(2, "a", 0)] == "extra:unknown,limit:out_of_range,no_result,query:not_string"
    assert errors[(2, "x", 1)] == errors[(2, "y", 2)] == errors[(2, "z", 3)] == "cycle,no_result"
    assert errors[(2, "u", 4)] == "no_result,unknown_dependency"
    assert errors[(3, "d", 5)] == "duplicate_id"
    assert errors[(3, None, 6)] == "missing_id"
    assert errors[(3, "e", 7)] == "no_result,unknown_tool"
    assert errors[(3, "f", 8)] == errors[(3, "g", 9)] == errors[(3, "h", 10)] == "arguments:not_an_object,no_result"
    assert errors[(4, "o", 1)] == "no_call"
    first = found[(1, "a", 0)]["json"]
    assert first == '{"arguments":{"key":"k\\n\\"é","strict":true},"errors":[],"id":"a","name":"lookup","result":"r1"}'
    for row in found.values():
        own = json.loads(row["json"])
        assert row["json"] == json.dumps(own, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_empty_tables_and_plain_conversations(spark):
    assert _linked(spark, [], []) == {}
    assert list(_linked(spark, [], [(1, "a", 0, "x")]).values())[0]["errors"] == "no_call"
    schema = "conv_id bigint, turn bigint, role string, text string, name string"
    messages = [(1, 1, "user", None, "n"), (1, 2, "assistant", None, "n"), (1, 3, "user", "", "n"), (None, 4, None, "x", "n")]
    rows = chat.report(spark.createDataFrame(messages, schema)).collect()
    assert len(rows) == 2
    assert chat.report(spark.createDataFrame([], schema)).count() == 0
