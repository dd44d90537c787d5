"""The lexer against a slow exact version that writes every value out, and texts that are built to be slow."""

import math
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from firnline.llm import secrets
from firnline.llm.secrets import _BARE, _GLUE, _KEY, _KEYED, _OPERATOR, _PLACEHOLDER, _STRING


def slow_score(value):
    if len(value) < 6 or _PLACEHOLDER.match(value) or " " in value.strip():
        return -10.0
    counts = Counter(ord(c) if ord(c) < 128 else 128 + ord(c) % 128 for c in value)
    entropy = -math.fsum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(entropy, 4.0) / 2 + 0.5 * kinds + (len(value) >= 16)


def slow_target(text, stop):
    """Names and subscripts read from the whole text before the operator."""
    keys = []
    head = text[:stop]
    while m := re.search(r"""\[[ \t]*([A-Za-z]{0,2}(?:"[^"\n]+"|'[^'\n]+'|`[^`\n]+`)|[^\[\]\n"'`]*)[ \t]*\][ \t]*\Z""", head):
        keys += [k[1:-1] for k in _KEY.findall(m[1])][::-1]
        head = head[: m.start()].rstrip(" \t")
    m = re.search(r"""(?P<q>["']?)(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z0-9_$]+)*)(?P=q)\Z""", head, re.ASCII)
    return "\n".join([*keys, *([m["name"]] if m else [])]) or None


def slow_spans(text):
    out, bound, told, run, ops = set(), {}, set(), -1, list(_OPERATOR.finditer(text))
    for i, op in enumerate(ops):
        name, at = slow_target(text, op.start()), op.end()
        stop = min([x for x in (text.find("\n", at),) if x >= 0], default=len(text))
        if not name:
            continue
        parts, first, last, inside = [], -1, -1, False
        while at < stop:
            m = _STRING.match(text, at, stop)
            if m:
                part, a, b = (m[1][1:-1], (m.span(1),), ()), m.start(1) + 1, m.end(1) - 1
            else:
                m = _BARE.match(text, at, stop)
                if not m:
                    break
                a, b = m.span()
                more = any(a <= o.start() < b for o in ops[i + 1 :])
                if parts and more:
                    break
                if more:
                    inside = True
                    parts, first, last = [(text[a:b], ((a, b),), ())], a, b
                    break
                keyed = _KEYED.match(text, b, stop)
                keys = [k[1:] if k[0] == ":" else k[1:-1] for k in _KEY.findall(keyed[0])] if keyed else []
                path = "\n".join([*keys[::-1], m[0]])
                if keyed and path in bound:
                    b, m = keyed.end(), keyed
                known = bound.get(path) or bound.get(m[0])
                part = (known[0], (), known[1]) if known else (m[0], ((a, b),), ())
            parts.append(part)
            first, last = (a if first < 0 else first), b
            at = m.end()
            glue = _GLUE.match(text, at, stop)
            if not glue:
                break
            at = glue.end()
        if not parts:
            continue
        value = "".join(p[0] for p in parts)
        own, others = [s for p in parts for s in p[1]], [s for p in parts for s in p[2]]
        if not (inside and first < run):
            bound[name] = value, (*own, *others)
        run = max(run, last) if inside else run
        score = secrets.name_score(name)
        if score >= 2 and score + slow_score(value) >= 5:
            out.add(("lexed", first, last))
            out |= {("lexed", *s) for s in others if s not in told}
            told |= {*own, *others}
    return sorted(out)


PIECES = [
    "a", "b", "db_pwd", "password", "cfg", '["key"]', '["password"]', " = ", "=", ": ", ":", " := ", " => ", "==", " + ", "..", "\n", "\n", "\n", " ", "  ", '"hunter2xyz9"',
    "'Zq7'", '"ab cd"', "Xy12Zw34", "&", ";", ",", "'", '"', "$", "${x}", "-", ".", "http://u:p@h", "é9", "`k9Jq`", "a.b", "a-b", "1",
]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_lexer_against_slow_version(text):
    got = secrets.lexed_spans(text)
    assert sorted(set(got)) == slow_spans(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aA0 \t<>x*é$", max_size=12), min_size=1, max_size=4))
def test_measures_join_like_texts(parts):
    whole = None
    for p in parts:
        m = secrets.measure(p)
        whole = m if whole is None else secrets.joined(whole, m)
    assert secrets.measure_score(whole) == secrets.literal_score("".join(parts)) == slow_score("".join(parts))


def test_constants_that_double():
    text = "aa = 'abcdefgh'\n" + "aa = aa + aa\n" * 1000 + "db_password = aa\n"
    began = time.time()
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == ["aa", "'abcdefgh'"]
    assert time.time() - began < 5


UNITS = [
    "a=1&", "token=1&", "token:", "token=", "password:b=", "=", ":", "a = 'x' + ", 'a = "1" + ', '"a= " + " + " + ', "aa = aa + aa\n", "a='b=", '="\\"', " ", "\t", "x ", "]=", "[1]=", '["k"]=', "'",
    "a.", "a-", "--", "a..", "&a", "&", "token   ", "key='", "pw = `", "AKIA", "deadbeef", "password=",
]


@pytest.mark.parametrize("unit", UNITS)
def test_time_is_linear(unit):
    took = []
    for size in (250_000, 1_000_000):
        text = unit * (size // len(unit))
        began = time.process_time()
        secrets.find_spans(text)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 1.0, took


@pytest.mark.parametrize("name", ["a" * 400 + "_password", "x." * 300 + "password", "p" + "-q" * 200 + "-secret"])
def test_names_of_any_length(name):
    assert [x for x in secrets.lex(f'{name} = "hunter2xyz9"')] == [(name, len(name) + 4, len(name) + 15, "hunter2xyz9")]
    assert len(secrets.lexed_spans(f'{name} = "hunter2xyz9"')) == 1


def test_query_strings():
    text = "http://h/p?user=bob&db_pwd=hunter2xyz9&page=2"
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == ["hunter2xyz9"]
    text = "cmd: -Ddb.pwd=Hunter2&xyz9 --verbose"
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == ["Hunter2&xyz9"]


def test_n_chars_of_other_types(spark):
    for kind in ("string", "double", "int", "boolean"):
        docs = spark.sql(f"select 1L as doc_id, 'token = abcdef123456' as text, cast(20 as {kind}) as n_chars union all select 2L, 'plain', cast(null as {kind})")
        out = {r["doc_id"]: r for r in secrets.stage(spark, docs, "").collect()}
        assert out[1]["text"] == "<SECRET>" and out[2]["n_chars"] is None
        assert kind == "boolean" or float(out[1]["n_chars"]) == 8.0
