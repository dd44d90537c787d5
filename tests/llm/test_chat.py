import json

from firnline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, rows):
    return [r.asDict() for r in chat.link_tool_calls(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "position").collect()]


def test_calls_results_and_order(spark):
    calls = {"tool_calls": [
        {"id": "a", "name": "reply", "arguments": {"prompt": "x", "z": 1, "after": {"$ref": "b"}}},
        {"id": "b", "name": "f", "arguments": '{"q": [1, {"b": 2, "a": 1}]}'},
        {"id": "a", "function": {"name": "reply", "arguments": {"prompt": 5}}},
    ]}
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", json.dumps(calls)), (1, 2, "tool", '{"tool_call_id":"a","content":"ok"}'),
        (1, 3, "tool", '{"tool_call_id":"b","content":"é\\n"}'), (1, 4, "tool", '{"tool_call_id":"zz","content":"?"}'), (1, 5, "tool", '{"tool_call_id":"b","content":"late"}'),
    ]
    out = linked(spark, rows)
    place = {(r["kind"], r["call_id"], r["idx"]): r["position"] for r in out}
    assert place[("call", "b", 1)] < place[("call", "a", 0)] < place[("result", "a", 0)]
    status = {(r["kind"], r["call_id"], r["turn"], r["idx"]): r["status"] for r in out}
    assert status[("call", "a", 1, 0)] == "linked" and status[("call", "a", 1, 2)] == "duplicate" and status[("result", "zz", 4, 0)] == "orphan"
    assert status[("result", "b", 5, 0)] == "duplicate" and status[("call", "c0", 0, 0)] == "unanswered"
    errors = {(r["call_id"], r["idx"]): r["errors"] for r in out if r["kind"] == "call"}
    assert errors[("a", 0)] == "unknown field z" and errors[("b", 1)] == "unknown tool f" and errors[("a", 2)] == "prompt is not string"
    text = next(r["canonical"] for r in out if r["call_id"] == "b" and r["kind"] == "call")
    assert text == json.dumps({"arguments": {"q": [1, {"a": 1, "b": 2}]}, "id": "b", "kind": "call", "name": "f", "result": "é\n"}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert [r["position"] for r in out] == list(range(len(out)))


def test_dialogue_and_odd_rows(spark):
    rows = [(2, 0, "system", "s"), (2, 1, "user", ""), (2, 2, "assistant", None), (2, 3, "user", "q" * 100000), (None, None, None, None), (3, 2, "user", "alone"), (3, 2, "user", "alone")]
    out = linked(spark, rows)
    assert len(out) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in out}
    assert by[(2, 0)]["status"] == "context" and by[(2, 1)]["status"] == "linked" and by[(2, 1)]["errors"] == "prompt is blank"
    assert by[(2, 3)]["status"] == "unanswered" and by[(2, 3)]["errors"] == "" and by[(3, 2)]["errors"] == "no call c0"
    assert by[(None, None)]["status"] == "context"
    assert linked(spark, []) == []


def test_bad_arguments_and_cycles(spark, monkeypatch):
    monkeypatch.setattr(chat, "MAX_ROUNDS", 3)
    calls = [{"id": "x", "name": "reply", "arguments": "not json"}, {"id": "p", "name": "reply", "arguments": {"prompt": "1", "after": {"$ref": "q"}}}, {"id": "q", "name": "reply", "arguments": {"prompt": "2", "after": {"$ref": "p"}}}]
    out = linked(spark, [(1, 0, "assistant", json.dumps({"tool_calls": calls}))])
    assert next(r for r in out if r["call_id"] == "x")["errors"] == "arguments are not JSON"
    assert "cyclic" in {r["status"] for r in out if r["call_id"] in "pq"}


def test_no_python_in_the_plan(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes")]
    plan = chat.link_tool_calls(spark.createDataFrame(rows, SCHEMA).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan.replace("ArrowScan", "")
