"""Schemas at any depth, against a plain validator, and identifiers with escapes."""

import json
import random

from firnline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TOOL = {
    "type": "object", "required": ["city", "when"], "additionalProperties": False,
    "properties": {
        "city": {"type": "string", "minLength": 2, "maxLength": 5, "pattern": "^[A-Z]"}, "unit": {"enum": ["C", "F", 1, None]}, "n": {"type": "integer", "minimum": 1, "maximum": 9},
        "x": {"type": ["number", "null"], "exclusiveMinimum": 0, "exclusiveMaximum": 2.5}, "flag": {"type": "boolean", "const": True},
        "when": {"type": "object", "required": ["day"], "properties": {"day": {"type": "string"}, "hours": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "integer", "minimum": 0}}}},
        "stops": {"type": "array", "items": {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {"id": {"type": "string"}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}}},
    },
}


def kind_of(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else {str: "string", dict: "object", list: "array"}[type(v)]


def valid(v, s):
    """Whether a value fits a schema, by recursion; a null field is one that is not there."""
    kind = kind_of(v)
    kinds = s.get("type")
    if kinds and not any(k == kind or (k == "integer" and kind == "number" and v == int(v)) for k in (kinds if isinstance(kinds, list) else [kinds])):
        return False
    same = lambda a, b: kind_of(a) == kind_of(b) and a == b
    if "enum" in s and not any(same(v, x) for x in s["enum"]) or "const" in s and not same(v, s["const"]):
        return False
    if kind == "number" and (v < s.get("minimum", v) or v > s.get("maximum", v) or v <= s.get("exclusiveMinimum", v - 1) or v >= s.get("exclusiveMaximum", v + 1)):
        return False
    if kind == "string" and (len(v) < s.get("minLength", 0) or len(v) > s.get("maxLength", len(v)) or ("pattern" in s and not v[:1].isupper())):
        return False
    if kind == "array" and (len(v) < s.get("minItems", 0) or len(v) > s.get("maxItems", len(v)) or any(not valid(x, s.get("items", {})) for x in v)):
        return False
    if kind == "object":
        fields = s.get("properties", {})
        if any(v.get(r) is None for r in s.get("required", [])) or (s.get("additionalProperties") is False and set(v) - set(fields)):
            return False
        return all(valid(v[f], fields[f]) for f in fields if f in v and (v[f] is not None or "null" in fields[f].get("type", "")))
    return True


def values(rng):
    pick = lambda *x: rng.choice(x)
    hours = lambda: [pick(0, 5, -1, 2.0, 2.5, "1", None) if rng.random() < 0.2 else 3 for _ in range(rng.randint(0, 4))]
    out = {"city": pick("Rome", "Oslo", "Bonn", "Graz", "Kiel", "Lima", "x", "Xylophone", "rome", 5), "when": pick({"day": "mon"}, {"day": "thu"}, {"day": "fri"}, {"day": "sat", "hours": [1, 2]}, {"day": "tue", "hours": hours()}, {}, {"day": 1}, [], {"day": "x", "more": [1]})}
    more = {"unit": pick("C", "K", 1, 1.5, None), "n": pick(1, 9, 10, 0, 2.0, 2.5, "3"), "x": pick(1, 2.5, 0, None, "a", 0.1), "flag": pick(True, False, 1), "zzz": 1}
    more["stops"] = [pick({"id": "a"}, {"id": "b", "tags": ["a", "b"]}, {"id": "c", "tags": ["z"]}, {"tags": []}, {"id": "d", "q": 1}, 7) if rng.random() < 0.3 else {"id": "ok"} for _ in range(3)]
    for k, v in more.items():
        if rng.random() < (0.05 if k == "zzz" else 0.25):
            out[k] = v
    if rng.random() < 0.1:
        out.pop(rng.choice(list(out)))
    return out


def linked(spark, rows, **kw):
    return [r.asDict() for r in chat.link_tool_calls(spark.createDataFrame(rows, SCHEMA), **kw).collect()]


def test_schemas_against_recursion(spark):
    rng = random.Random(11)
    cases = [values(rng) for _ in range(400)]
    rows = [(i, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "weather", "arguments": c}]})) for i, c in enumerate(cases)]
    out = {r["conv_id"]: r["errors"] for r in linked(spark, rows, schemas={"weather": TOOL})}
    for i, c in enumerate(cases):
        assert (out[i] == "") == valid(c, TOOL), (c, out[i])
    assert 50 < sum(e == "" for e in out.values()) < 350


def test_error_texts(spark):
    bad = {"city": "x", "n": 12, "unit": "K", "when": {"hours": [1, -1, "a"]}, "stops": [{"q": 1}], "zz": 0}
    out = linked(spark, [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "weather", "arguments": bad}]}))], schemas={"weather": TOOL})
    want = {
        "city is shorter than 2", "city is not like ^[A-Z]", 'unit is not one of "C" "F" 1 null', "n is over 9", "when.day is missing", "when.hours[] is under 0", "when.hours[] is not integer",
        "stops[].id is missing", "unknown field stops[].q", "unknown field zz",
    }
    assert set(out[0]["errors"].split("; ")) == want


def test_escaped_identifiers_and_quoted_references(spark):
    odd = 'é "q" \\ \n$ref'
    calls = [{"id": "a", "name": "reply", "arguments": {"prompt": 'say "$ref":"b"', "after": {"$ref": odd}}}, {"id": odd, "name": "reply", "arguments": {"prompt": "p"}}]
    for text in (json.dumps({"tool_calls": calls}), json.dumps({"tool_calls": calls}, ensure_ascii=False), json.dumps({"tool_calls": calls}).replace("$ref", "\\u0024ref")):
        out = {r["call_id"]: r for r in linked(spark, [(1, 0, "assistant", text)])}
        assert out["a"]["errors"] == "" and out[odd]["position"] < out["a"]["position"]


def test_items_without_identifiers(spark):
    rows = [(1, 2 * i + j, "tool" if j else "system", '{"content": "no id"}') for i in range(50) for j in (0, 1)] + [(1, None, None, None)] * 3
    rows += [(1, 200, "assistant", json.dumps({"tool_calls": [{"name": "reply", "arguments": {"prompt": "x"}}]}))]
    out = linked(spark, rows)
    assert len(out) == len(rows) and {r["status"] for r in out} == {"context", "unnamed"} and sorted(r["position"] for r in out) == list(range(len(rows)))
