"""References that run against time, over many calls."""

import json
import random

from firnline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, conversations):
    """conversations: {conv_id: {call_id: ids it refers to}}, one message each, calls in the given order, all answered."""
    rows = []
    for conv, refs in conversations.items():
        calls = [{"id": c, "name": "reply", "arguments": {"prompt": c, "after": [{"$ref": d} for d in deps]}} for c, deps in refs.items()]
        rows.append((conv, 0, "assistant", json.dumps({"tool_calls": calls})))
        rows += [(conv, i + 1, "tool", json.dumps({"tool_call_id": c, "content": c})) for i, c in enumerate(refs)]
    out = [r.asDict() for r in chat.link_tool_calls(spark.createDataFrame(rows, SCHEMA)).collect()]
    return {(r["conv_id"], r["call_id"]): r for r in out if r["kind"] == "call"}


def test_long_chains_are_ordered_and_only_cycles_are_cyclic(spark):
    rng = random.Random(5)
    chain = {f"k{i}": [f"k{i + 1}"] if i < 39 else [] for i in range(40)}
    names = [f"n{i}" for i in range(60)]
    dag = {n: rng.sample(names[:i], min(i, rng.randint(0, 3))) for i, n in enumerate(names)}
    dag = dict(rng.sample(list(dag.items()), len(dag)))
    ring = chain | {"k39": ["r0"], "r0": ["r1"], "r1": ["r2"], "r2": ["r0"], "s0": ["s1"], "s1": [], "self": ["self"]}
    out = linked(spark, {1: chain, 2: dag, 3: ring})
    for conv, refs in ((1, chain), (2, dag)):
        for c, deps in refs.items():
            assert out[conv, c]["status"] == "linked" and out[conv, c]["peer_turn"] is not None and '"result"' in out[conv, c]["canonical"]
            assert all(out[conv, d]["position"] < out[conv, c]["position"] for d in deps)
    assert {c for c in ring if out[3, c]["status"] != "cyclic"} == {"s0", "s1"}
    assert out[3, "s1"]["position"] < out[3, "s0"]["position"]
