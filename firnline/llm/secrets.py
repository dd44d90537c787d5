"""Secret scans: base patterns plus assignment-aware lexing.

The lexer reads source code and configuration syntax (NAME = value, name: value, "name": "value", export NAME=value,
-Dname=value, ...) into name-literal pairs, joins adjacent and "+"-concatenated string literals, propagates
constants from earlier assignments of the same text (password = DEFAULT_PW), and scores each literal by its target
name's sensitive parts and by its own form. Spans that reach the threshold are added as kind "lexed"; base spans
are never dropped. Names, subscripts and values may be of any length; the scan is linear in the text, and what it
keeps of a constant is where its parts stand, so constants that repeat themselves cost no more than they are long in
the text (values of over 2**50 characters are measured in proportion). Where a sensitive name gets its value through constants, the literals they were bound to are
lexed spans too, quotes included, beside the reference.

All offsets are code points, end exclusive. A base span is the whole match of its pattern.

Defined cases: a null text is an empty one and has no spans; texts of any length are scanned whole; repeated rows
give equal rows; an empty table gives no rows; columns other than id and text are ignored by the scan and kept as
they are by the redaction stage.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm.common import bounded, load

KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run that fails holds no longer match, so the bound is in the pattern
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN = 6

#: How much a part of a target name says that its value is secret.
NAME_PARTS = {
    "password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "pass": 3, "secret": 4, "token": 3, "credential": 4,
    "credentials": 4, "apikey": 4, "privatekey": 4, "key": 2, "auth": 2, "private": 2, "access": 1, "api": 1,
    "bearer": 3, "signing": 2, "session": 1, "cookie": 1, "dsn": 2, "salt": 2, "pin": 1,
}
THRESHOLD = 5.0
MIN_LITERAL = 6
_FULL_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*+(?:[.\-][A-Za-z0-9_$]++)*+", re.ASCII)
_NAME_START = re.compile(r"[A-Za-z_$]", re.ASCII)
_NAME_BACK = re.compile(r"""(["']?)([A-Za-z0-9_$.\-]*+)""", re.ASCII)
_OPERATOR = re.compile(r"(?<![ \t])[ \t]*+(?::=|=>|(?<![=!<>])=(?!=)|:(?!:|//))[ \t]*+")
#: A subscript in the reversed text, so that those before an operator are read from it, however long: a string, or
#: anything with balanced brackets.
_SUBSCRIPT = re.compile(
    r"""[ \t]*+\](?:[ \t]*+(?P<string>"[^"\n]*+"|'[^'\n]*+'|`[^`\n]*+`)[A-Za-z]{0,2}[ \t]*+\[|(?P<other>(?:[^\[\]\n]++|\][^\[\]\n]*+\[)*+)\[)[ \t]*+"""
)
_KEYED = re.compile(r"""(?:[ \t]*\[[ \t]*(?:[A-Za-z]{0,2}(?:"[^"\n]*"|'[^'\n]*'|`[^`\n]*`)|:\w+)[ \t]*\])++""")
_KEY = re.compile(r""""[^"\n]*"|'[^'\n]*'|`[^`\n]*`|:\w+""")
_GLUE = re.compile(r"[ \t]*+(?:\+|\.\.)[ \t]*+|[ \t]++(?=[\"'])")
_STRING = re.compile(r"""[A-Za-z]{0,2}("(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)""")
#: Up to the next blank, quote or bracket, or the "&" before the next parameter of a query string.
_BARE = re.compile(r"""(?:[^\s"'`,;{}()\[\]<>&]|&(?![A-Za-z_][A-Za-z0-9_.\-]*+=))++""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{?.*|%\(?.*|none|null|nil|true|false|changeme|example|your[_-].*|todo|string|str)$")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "=" in text or ":" in text:  # else no assignment can match
        out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """Of a name with keys: its parts, and the best of name and keys as a compound."""
    split = [[p.lower() for p in _PARTS.findall(n)] for n in name.split("\n")]
    compound = max(NAME_PARTS.get("".join(parts), 0) * (len(parts) > 1) for parts in split)
    return float(sum(NAME_PARTS.get(p, 0) for p in dict.fromkeys(p for parts in split for p in parts)) + compound)


#: Every part of a name, and every compound, stands in the text's letters and digits without what is between them; a text
#: whose letters and digits hold no listed part has no name that scores.
_BETWEEN = re.compile(r"[^a-z0-9]+")
_ANY_PART = re.compile("|".join(NAME_PARTS))
_HEAD = 16  # first characters that a measure keeps; no placeholder that is a fixed word is as long
_MOST = float(1 << 50)  # longer values, which only constants that repeat themselves can have, count in proportion


@dataclass(slots=True)
class Measure:
    """What a value is scored by, of bounded size however long the value: its length, how often each character occurs
    (ASCII by itself, others in 128 classes by their low bits), its first characters and its last, and where it has blanks."""

    length: float
    counts: dict[int, float]
    head: str
    last: str
    core: bool  # has something but blanks
    blanks: tuple[bool, bool, bool]  # before, inside and after the core


def measure(value: str) -> Measure:
    counts: dict[int, float] = {}
    for c, n in Counter(value).items():
        k = ord(c) if c < "\x80" else 128 + (ord(c) & 127)
        counts[k] = counts.get(k, 0) + n
    left, right = value.lstrip(), value.rstrip()
    ends = " " in value[: len(value) - len(left)], " " in left.strip(), bool(left) and " " in value[len(right) :]
    return Measure(len(value), counts, value[:_HEAD], value[-1:], bool(left), ends)


def joined(a: Measure, b: Measure) -> Measure:
    """The measure of two values in a row."""
    if not a.length or not b.length:
        return a if a.length else b
    counts = dict(a.counts)
    for k, n in b.counts.items():
        counts[k] = counts.get(k, 0) + n
    length = a.length + b.length
    if length > _MOST:
        counts = {k: n * (_MOST / length) for k, n in counts.items()}
        length = _MOST
    (p, q, r), (x, y, z) = a.blanks, b.blanks
    if not a.core:
        blanks = (p or x, y, z)
    elif not b.core:
        blanks = (p, q, r or x)
    else:
        blanks = (p, q or y or r or x, z)
    return Measure(length, counts, (a.head + b.head)[:_HEAD] if len(a.head) < _HEAD else a.head, b.last, a.core or b.core, blanks)


def _is_placeholder(m: Measure) -> bool:
    if m.length <= _HEAD:
        return bool(_PLACEHOLDER.match(m.head))
    of_one = m.counts.keys() <= {120, 88} or m.counts.keys() <= {42} or m.counts.keys() <= {46}
    return of_one or (m.head[0] == "<" and m.last == ">") or m.head[0] in "$%" or bool(re.match("(?i)your[_-]", m.head))


def measure_score(m: Measure) -> float:
    """Entropy and mix of character classes; placeholders, words and references score nothing."""
    if m.length < MIN_LITERAL or _is_placeholder(m) or m.blanks[1]:
        return -10.0
    entropy = -math.fsum(c / m.length * math.log2(c / m.length) for c in m.counts.values() if c > 0)
    lower, upper, digit = (any(a <= k <= b for k in m.counts) for a, b in ((97, 122), (65, 90), (48, 57)))
    other = any(not (97 <= k <= 122 or 65 <= k <= 90 or 48 <= k <= 57) for k in m.counts)
    return min(entropy, 4.0) / 2 + 0.5 * (lower + upper + digit + other) + (1.0 if m.length >= 16 else 0.0)


def literal_score(value: str) -> float:
    return measure_score(measure(value))


def _keys(subscript: str) -> list[str]:
    """The string keys (and symbols) of a subscript's inside; an index or a variable is none."""
    subscript = subscript.strip()
    if subscript.startswith(":"):
        return [subscript[1:]] if subscript[1:].isidentifier() else []
    return [k[1:-1] for k in _KEY.findall(subscript) if k[0] != ":"]


def _name_before(back: str, at: int) -> str | None:
    """The name, or the quoted name, that ends at a place of the reversed text."""
    m = _NAME_BACK.match(back, at)
    run = m[2][::-1]
    if m[1]:
        return run if back[m.end() : m.end() + 1] == m[1] and _FULL_NAME.fullmatch(run) else None
    if not run or run[-1] in ".-":
        return None
    start = max(run.rfind(x) for x in ("..", ".-", "-.", "--"))
    first = _NAME_START.search(run, start + 2 if start >= 0 else 0)
    return run[first.start() :] if first else None


def _target(back: str, at: int) -> str | None:
    """The name assigned to by the operator that starts at a place of the reversed text; string keys of subscripts stand
    before it, last key first, each on a line, and alone if what they belong to is no plain name."""
    keys = []
    while m := _SUBSCRIPT.match(back, at):
        keys += _keys((m["string"] or m["other"] or "")[::-1])[::-1]
        at = m.end()
    name = _name_before(back, at)
    return "\n".join([*keys, *([name] if name else [])]) or None


class Value:
    """What a name is bound to: literals (start, end, inner start, inner end) and values of other names, in order."""

    __slots__ = ("parts", "known", "told")

    def __init__(self, parts: list):
        self.parts, self.known, self.told = parts, None, False

    def measure(self, text: str) -> Measure:
        todo = [self]
        while todo:
            v = todo[-1]
            if v.known is None:
                if missing := [p for p in v.parts if isinstance(p, Value) and p.known is None]:
                    todo += missing
                    continue
                m = None
                for p in v.parts:
                    one = p.known if isinstance(p, Value) else measure(text[p[2] : p[3]])
                    m = one if m is None else joined(m, one)
                v.known = m
            todo.pop()
        return self.known

    def text(self, text: str) -> str:
        return "".join(p.text(text) if isinstance(p, Value) else text[p[2] : p[3]] for p in self.parts)

    def tell(self) -> list[tuple[int, int]]:
        """The literals, quotes included, of the values it refers to, each told once."""
        out, todo = [], [p for p in self.parts if isinstance(p, Value)]
        self.told = True
        while todo:
            v = todo.pop()
            if not v.told:
                v.told = True
                todo += [p for p in v.parts if isinstance(p, Value)]
                out += [p[:2] for p in v.parts if not isinstance(p, Value)]
        return out


def lex(text: str) -> list[tuple[str, int, int, str]]:
    """(target name, start, end, resolved value) of every assignment whose value is a literal, a concatenation of
    literals, or a name bound to one before. The span covers the literal (or the reference) itself. The name of a
    subscripted target is its string keys, last key first, and the base name, each on a line. Values are written out
    here, however long constants make them; the scan itself only measures them."""
    return [(name, a, b, value.text(text)) for name, a, b, value, _ in _assignments(text)]


def _assignments(text: str) -> Iterator[tuple[str, int, int, Value, int]]:
    """(target, start, end, value, end of the bare run it shares with later operators or -1).

    A value ends before the next operator outside its own strings, but for a bare one: that goes to the end of its run
    (a:b=c), and the operators inside are assignments of their own, which bind no constant unless they are the run's last.
    So every character is read a bounded number of times."""
    bound: dict[str, Value] = {}
    back, n = text[::-1], len(text)
    ops = _OPERATOR.finditer(text)
    op, line, run = next(ops, None), -1, -1
    while op is not None:
        after = next(ops, None)
        name, at = _target(back, n - op.start()), op.end()
        if name:
            if line < at:
                line = text.find("\n", at)
                line = n if line < 0 else line
            parts, first, last, shared = [], -1, -1, -1
            while at < line:
                m = _STRING.match(text, at, line)
                if m:
                    part, a, b = (*m.span(1), m.start(1) + 1, m.end(1) - 1), m.start(1) + 1, m.end(1) - 1
                elif at < run and after is not None and after.start() < run:
                    parts, first, last, shared = [(at, run, at, run)], at, run, run
                    break
                else:
                    m = _BARE.match(text, at, line)
                    if not m:
                        break
                    a, b = m.span()
                    if parts and _OPERATOR.search(text, a, b):
                        break
                    if not parts and after is not None and after.start() < b:
                        parts, first, last, shared = [(a, b, a, b)], a, b, b
                        break
                    keyed = _KEYED.match(text, b, line)
                    keys = [k[1:] if k[0] == ":" else k[1:-1] for k in _KEY.findall(keyed[0])] if keyed else []
                    path = "\n".join([*keys[::-1], m[0]])
                    if keyed and path in bound:
                        b, m = keyed.end(), keyed
                    part = bound.get(path) or bound.get(m[0]) or (a, b, a, b)
                parts.append(part)
                first, last = (a if first < 0 else first), b
                at = m.end()
                glue = _GLUE.match(text, at, line)
                if not glue:
                    break
                at = glue.end()
            if parts:
                value = Value(parts)
                if shared < 0 or first >= run:
                    bound[name] = parts[0] if len(parts) == 1 and isinstance(parts[0], Value) else value
                yield name, first, last, value, (shared if first < run else -1)
                run = max(run, shared)
        op = after


def _suffix_scores(text: str, starts: list[int], end: int) -> list[float]:
    """The scores of text[start:end] for rising starts, in one pass from the end."""
    counts: dict[int, float] = {}
    out, at = [], end
    for start in reversed(starts):
        for k, c in measure(text[start:at]).counts.items():
            counts[k] = counts.get(k, 0) + c
        at = start
        out.append(measure_score(Measure(end - start, counts, text[start : start + _HEAD], text[end - 1], True, (False, False, False))))
    return out[::-1]


def lexed_spans(text: str) -> list[tuple[str, int, int]]:
    if ("=" not in text and ":" not in text) or not _ANY_PART.search(_BETWEEN.sub("", text.lower())):
        return []
    out, waiting, run = [], [], -1  # sensitive names inside a bare run, scored together

    def settle() -> None:
        if waiting:
            for (a, score), own in zip(waiting, _suffix_scores(text, [a for a, _ in waiting], run)):
                if score + own >= THRESHOLD:
                    out.append(("lexed", a, run))
            waiting.clear()

    for name, a, b, value, shared in _assignments(text):
        if waiting and a >= run:
            settle()
        score = name_score(name)
        if score < 2:
            continue
        if shared >= 0:
            run = shared
            waiting.append((a, score))
        elif score + measure_score(value.measure(text)) >= THRESHOLD:
            out.append(("lexed", a, b))
            out += [("lexed", *s) for s in value.tell()]
    settle()
    return out


def find_spans(text: str) -> list[tuple[str, int, int]]:
    base = base_spans(text)
    spans = base + lexed_spans(text)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _join(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by a marker; overlapping spans are one."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], "<SECRET>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("n_lexed", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
])
_DDL = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                spans = find_spans(text or "")
                n = Counter(k for k, _, _ in spans)
                base = _join(s for s in spans if s[0] != "lexed")
                rows.append((doc_id, n["assign"], n["access"], n["hex"], n["lexed"], hashlib.sha256(base.encode()).hexdigest(), _join(spans)))
        cols = zip(*rows) if rows else [[] for _ in _FIELDS]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FIELDS)], schema=_FIELDS)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, _DDL)


@bounded
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(load(spark, sf_dir, "documents"))


@bounded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets replaced by a marker and n_chars (if present, as a number or text) brought up to
    date."""
    del spark, sf_dir

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column("text").to_pylist()
                new = [t if t is None else redact(t, find_spans(t)) for t in texts]
                i = part.schema.get_field_index("text")
                part = part.set_column(i, part.schema.field(i), pa.array(new, part.schema.field(i).type))
                if "n_chars" in part.schema.names:
                    j = part.schema.get_field_index("n_chars")
                    kind = part.schema.field(j).type
                    if pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind) or pa.types.is_large_string(kind):
                        lens = pa.array([None if a is b or a == b else len(b) for a, b in zip(texts, new)], pa.int64()).cast(kind, safe=False)
                        part = part.set_column(j, part.schema.field(j), pc.coalesce(lens, part.column(j)))
                yield part

    return docs.mapInArrow(clean, docs.schema)
