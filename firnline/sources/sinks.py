"""Sinks: partitioned Parquet, file naming templates and attribute templates."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from firnline.functions.vocab import null_to_missing, smallest_integer
from pyspark.sql import functions as F


def write_records(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fill: bool = False) -> None:
    """Parquet, one folder per partition value; with mode "overwrite" only the partitions that df holds are replaced."""
    out = null_to_missing(df) if fill else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def narrow_flags(df: DataFrame, flag_values: Mapping[str, Sequence[int]]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(smallest_integer(v)) for c, v in flag_values.items() if c in df.columns})


def by_month(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({"year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM")})


_FIELD = re.compile(r"\{(\w+)(?::([^{}]*))?\}")


def fill_template(template: str, attributes: Mapping[str, object], formats: Mapping[str, Callable] | None = None) -> str:
    """"{name}", "{name:upper}", "{name:%Y%m%d}" and chains "{name:lower;[:3]}" filled from attributes. Unknown names are
    an error."""

    def value(m: re.Match) -> str:
        if m[1] not in attributes:
            raise KeyError(f"template field {m[1]!r} is not known")
        out: object = attributes[m[1]]
        for option in filter(None, (m[2] or "").split(";")):
            if formats and option in formats:
                out = formats[option](out)
            elif option in ("upper", "lower"):
                out = getattr(str(out), option)()
            elif "%" in option and hasattr(out, "strftime"):
                out = out.strftime(option)
            elif (cut := re.fullmatch(r"\[(-?\d*):(-?\d*)\]", option)):
                out = str(out)[int(cut[1]) if cut[1] else None : int(cut[2]) if cut[2] else None]
            else:
                raise ValueError(f"template option {option!r} is not known")
        return str(out)

    return _FIELD.sub(value, template)


def describe(df: DataFrame, attributes: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Variable attributes as column metadata."""
    return df.select(*[F.col(c).alias(c, metadata=dict(attributes[c])) if c in attributes else F.col(c) for c in df.columns])
