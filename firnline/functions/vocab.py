"""Code vocabularies and per-record provenance flags."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The surface-type and radar-mode codes of the record format.
SURFACE_TYPES = {"unknown": 0, "ocean": 1, "lead": 2, "polynya": 3, "sea_ice": 4, "closed_sea": 5, "land_ice": 6, "land": 7, "invalid": 8}
RADAR_MODES = {"lrm": 0, "sar": 1, "sin": 2}
# Bit positions of the record status flag.
ERROR_BITS = {
    "l1": 0, "l2proc": 1, "auxdata": 2, "surface_type": 3, "retracker": 4, "range_correction": 5, "sea_level": 6, "freeboard": 7,
    "thickness": 8, "filter": 9, "other": 15,
}


def all_of(*conditions: Column) -> Column:
    """Accumulated AND."""
    return reduce(and_, conditions)


def any_of(*conditions: Column) -> Column:
    """Accumulated OR."""
    return reduce(or_, conditions)


def surface_code(name: str) -> Column:
    return F.lit(SURFACE_TYPES[name]).cast("tinyint")


def is_surface(column: Column, *names: str) -> Column:
    return column.isin(*[SURFACE_TYPES[n] for n in names])


def raise_bit(flag: Column, bit: int, condition: Column) -> Column:
    """Bitwise OR, so steps that share a bit do not carry into the next one."""
    return flag.bitwiseOR(F.when(F.coalesce(condition, F.lit(False)), F.lit(1 << bit)).otherwise(F.lit(0)))


def has_bit(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(1 << bit)) != 0


def null_pair(value: str, condition: Column, unc: str | None = None) -> dict[str, Column]:
    """Columns with value and its uncertainty nulled together where the condition holds."""
    unc = unc or f"{value}_uncertainty"
    clear = F.coalesce(condition, F.lit(False))
    return {c: F.when(~clear, F.col(c)) for c in (value, unc)}


def missing_to_null(df, fills: dict | None = None):
    """NaN (and declared fill values) become NULL in every floating column: comparisons with NaN differ between engines,
    with NULL they don't."""
    out = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            bad = F.isnan(c)
            if fills and name in fills:
                bad = bad | (c == F.lit(fills[name]))
            out[name] = F.when(~bad, c)
        elif kind == "array<double>" or kind == "array<float>":
            out[name] = F.transform(c, lambda x: F.when(~F.isnan(x), x))
        elif fills and name in fills:
            out[name] = F.when(c != F.lit(fills[name]), c)
    return df.withColumns(out) if out else df


def null_to_missing(df, int_fill: int = -1):
    """The sink's convention: NaN for floating columns, a fill value for whole numbers."""
    out = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            out[name] = F.coalesce(F.col(name), F.lit(float("nan")).cast(kind))
        elif kind in ("tinyint", "smallint", "int", "bigint"):
            out[name] = F.coalesce(F.col(name), F.lit(int_fill).cast(kind))
    return df.withColumns(out) if out else df


def smallest_integer(values) -> str:
    """The narrowest signed type that holds every flag value."""
    low, high = min(values), max(values)
    for kind, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
        if -(1 << bits) <= low and high < (1 << bits):
            return kind
    return "bigint"
