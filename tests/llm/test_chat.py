from __future__ import annotations

import json

from sparkingest.llm.chat import link_tool_calls
from tests.llm.fixtures import with_extras

MESSAGES = "conv_id bigint, turn bigint, role string, text string"
TOOLS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False),
         ("find", "where", "object", False)]


def call(*calls):
    return json.dumps({"tool_calls": list(calls)})


def one(identifier, name="add", arguments=None, depends_on=()):
    return {
        "id": identifier, "name": name, "depends_on": list(depends_on),
        "arguments": {"b": 2, "a": 1} if arguments is None else arguments,
    }


def result(identifier, content="done"):
    return json.dumps({"tool_call_id": identifier, "content": content})


def linked(spark, rows):
    messages = with_extras(spark.createDataFrame(rows, MESSAGES))
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    return sorted(
        link_tool_calls(messages, tools).collect(),
        key=lambda r: (repr(r.conv_id), r.position, r.kind, repr(r.call_id)),
    )


def test_links_order_and_canonical_json(spark):
    got = linked(
        spark,
        [
            (1, 0, "user", "add é \"things\"\n"),
            (1, 1, "assistant", call(one("x"), one("y", depends_on=["x", "nowhere"]))),
            (1, 2, "tool", result("y")),
            (1, 3, "tool", result("x", "3")),
            (1, 4, "assistant", "both done"),
        ],
    )
    # The log has the result of y before that of x, on which y depends.
    order = [(r.kind, r.call_id) for r in got if r.kind != "message"]
    assert order == [("call", "x"), ("result", "x"), ("call", "y"), ("result", "y")]
    assert {r.status for r in got if r.kind != "message"} == {"answered"}
    for r in got:
        canonical = json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r.json == canonical
    assert json.loads(got[1].json)["arguments"] == {"a": 1, "b": 2}


def test_long_backward_chain_and_cycle(spark):
    chain = [(1, i, "assistant", call(one(f"c{i}", depends_on=[f"c{i + 1}"]))) for i in range(12)]
    chain += [(1, 20 + i, "tool", result(f"c{i}")) for i in range(13)]
    loop = [
        (2, 0, "assistant", call(one("p", depends_on=["q"]), one("q", depends_on=["p"]), one("z"))),
        (2, 1, "tool", result("p")),
        (2, 2, "tool", result("q")),
    ]
    got = linked(spark, chain + loop)
    place = {(r.conv_id, r.kind, r.call_id): r.position for r in got}
    for i in range(12):
        assert place[1, "call", f"c{i}"] < place[1, "result", f"c{i}"]
        if i < 11:
            assert place[1, "result", f"c{i + 1}"] < place[1, "call", f"c{i}"]
    status = {(r.conv_id, r.kind, r.call_id): r.status for r in got}
    assert status[1, "result", "c12"] == "orphan"
    assert status[2, "call", "p"] == status[2, "result", "q"] == "cycle"
    assert status[2, "call", "z"] == "unanswered"


def test_validation(spark):
    rows = [
        one("ok"),
        one("missing", arguments={"a": 1}),
        one("type", arguments={"a": 1.5, "b": 2, "note": 3}),
        one("extra", arguments={"a": 1, "b": 2, "c": None}),
        one("unknown", name="nothing"),
        one("list", arguments=[1]),
        one("object", name="find", arguments={"where": {"y": 1, "x": [True]}}),
        one("wrong", name="find", arguments={"where": "here"}),
    ]
    got = {r.call_id: r for r in linked(spark, [(1, 0, "assistant", call(*rows))])}
    assert {k: r.errors for k, r in got.items()} == {
        "ok": [], "missing": ["missing:b"], "type": ["type:a", "type:note"],
        "extra": ["unexpected:c"], "unknown": ["unknown_tool"],
        "list": ["arguments_not_an_object"], "object": [], "wrong": ["type:where"],
    }
    assert '"arguments":{"where":{"x":[true],"y":1}}' in got["object"].json


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "assistant", call(one("n"))),
        (None, 2, "tool", result("n")),
        (1, 0, "user", ""),
        (1, 1, "assistant", "{not json"),
        (1, 1, "assistant", '{"tool_calls": 5}'),
        (1, 2, "tool", "{}"),
        (1, 3, "tool", result(None)),
        (2, 0, "assistant", call(one("d"))),
        (2, 0, "assistant", call(one("d"))),
        (2, 1, "assistant", call(one("d"))),
        (2, 2, "tool", result("d")),
        (2, 3, "tool", result("d")),
        (3, 0, "assistant", call(one(None))),
        (3, 1, "user", "long " * 50_000),
    ]
    got = linked(spark, rows)
    status = sorted((repr(r.conv_id), r.kind, r.status) for r in got)
    assert ("None", "call", "answered") in status and ("None", "message", "plain") in status
    assert status.count(("2", "call", "duplicate")) >= 1
    assert status.count(("2", "result", "duplicate")) == 1
    assert ("1", "message", "orphan") in status
    assert len(got) == len(rows)
    assert linked(spark, []) == []


def test_nothing_beside_calls_and_results_is_lost(spark):
    nested = {"id": "n", "type": "function", "function": {"name": "add", "arguments": '{"b": 2, "a": 1}'}}
    rows = [
        (1, 0, "assistant", json.dumps({"tool_calls": [], "content": "none needed"})),
        (1, 1, "assistant", json.dumps({"tool_calls": [one("x")], "content": "let me see", "cost": 2})),
        (1, 2, "tool", "  " + json.dumps({"tool_call_id": "x", "content": "3", "seconds": [1, 2]})),
        (1, 3, "assistant", "\n " + json.dumps({"tool_calls": [nested]})),
        (1, 4, "tool", result("n")),
    ]
    got = linked(spark, rows)
    assert [(r.kind, r.call_id, r.status, r.errors) for r in got] == [
        ("message", None, "plain", []),
        ("message", None, "plain", []),
        ("call", "x", "answered", []),
        ("result", "x", "answered", []),
        ("call", "n", "answered", []),
        ("result", "n", "answered", []),
    ]
    assert json.loads(json.loads(got[0].json)["content"])["content"] == "none needed"
    assert got[1].json == '{"content":"let me see","cost":2,"role":"assistant"}'
    assert got[3].json == '{"content":"3","role":"tool","seconds":[1,2],"tool_call_id":"x"}'
    assert json.loads(got[4].json) == {
        "arguments": {"a": 1, "b": 2}, "depends_on": [], "id": "n", "name": "add",
        "role": "assistant", "type": "function",
    }


def test_equal_rows_are_one_first_and_duplicates(spark):
    rows = [(1, 0, "assistant", call(one("x")))] * 3 + [(1, 1, "tool", result("x"))] * 2
    got = linked(spark, rows)
    assert sorted((r.kind, r.status) for r in got) == [
        ("call", "answered"), ("call", "duplicate"), ("call", "duplicate"),
        ("result", "answered"), ("result", "duplicate"),
    ]
