"""Declared predicates compiled to Columns. The grammar is a whitelist; nothing is evaluated as code.

    clause   := "{name}" op value | "{name}" ("is_nan" | "is_valid")
    op       := >= | <= | == | != | > | <
    value    := number | "[" 12 numbers "]"     (one per month of the segment's first record)
"""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline.functions.vocab import SURFACE_TYPES, all_of

_CLAUSE = re.compile(r"^\s*\{?\s*(?P<name>[A-Za-z_]\w*)\s*\}?\s*(?:(?P<op>>=|<=|==|!=|>|<)\s*(?P<value>\S.*?)|(?P<test>is_nan|is_valid))\s*$")
_OPS = {">=": operator.ge, "<=": operator.le, "==": operator.eq, "!=": operator.ne, ">": operator.gt, "<": operator.lt}


class PredicateError(ValueError):
    pass


def _number(text: str) -> float | None:
    text = text.strip().lower()
    if text in ("nan", "none", "null", ".nan"):
        return None
    try:
        return float(text)
    except ValueError as e:
        raise PredicateError(f"not a number: {text!r}") from e


def compile_clause(clause: str, month: Column | None = None, name: str | None = None) -> Column:
    """A clause as a Column that is false where its parameter is missing. An empty "{}" takes the given name."""
    if name:
        clause = clause.replace("{}", "{" + name + "}")
    m = _CLAUSE.match(clause)
    if not m:
        raise PredicateError(f"cannot read predicate {clause!r}")
    c = F.col(m["name"])
    if m["test"]:
        return c.isNull() if m["test"] == "is_nan" else c.isNotNull()
    text = m["value"]
    if text.startswith("["):
        values = [_number(x) for x in text.strip("[] ").split(",")]
        if len(values) != 12:
            raise PredicateError(f"a monthly list has 12 values: {clause!r}")
        if month is None:
            raise PredicateError(f"{clause!r} needs a month column")
        bound = F.element_at(F.array(*[F.lit(v).cast("double") for v in values]), month.cast("int"))
    else:
        bound = F.lit(_number(text)).cast("double")
    return F.coalesce(_OPS[m["op"]](c, bound), F.lit(False))


def compile_all(clauses: Sequence[str] | Mapping[str, str], month: Column | None = None) -> Column:
    if isinstance(clauses, Mapping):
        return all_of(*[compile_clause(c, month, name) for name, c in clauses.items()])
    return all_of(*[compile_clause(c, month) for c in clauses])


def classify(
    rules: Sequence[Mapping], mode: Column | None = None, month: Column | None = None, default: str = "unknown", land: Column | None = None
) -> Column:
    """Ordered classification. rules: {"surface_type", "conditions", optional "radar_mode" and "exclude"}; a later
    rule overwrites an earlier one unless that class is excluded; land overlays everything at the end."""
    out = F.lit(SURFACE_TYPES[default])
    for rule in rules:
        hit = compile_all(rule["conditions"], month)
        if rule.get("radar_mode") is not None and mode is not None:
            hit = hit & (mode == F.lit(rule["radar_mode"]))
        if rule.get("exclude"):
            hit = hit & (out != F.lit(SURFACE_TYPES[rule["exclude"]]))
        out = F.when(hit, F.lit(SURFACE_TYPES[rule["surface_type"]])).otherwise(out)
    if land is not None:
        out = F.when(F.coalesce(land, F.lit(False)), F.lit(SURFACE_TYPES["land"])).otherwise(out)
    return out.cast("tinyint")


def mask_condition(text: str, source: str, threshold: float | None = None, zero: float = 1e-9) -> Column:
    """Conditions of the grid masks, e.g. "is_nan; is_zero" over one source, joined by the caller's connector."""
    c = F.col(source)
    tests = {"is_nan": c.isNull(), "is_zero": F.coalesce(F.abs(c) <= zero, F.lit(False)), "is_smaller": F.coalesce(c < F.lit(threshold), F.lit(False))}
    if text.strip() not in tests:
        raise PredicateError(f"unknown mask condition {text!r}")
    return tests[text.strip()]
