"""File manifests as DataFrames: discovery, name parsing, period selection and version choice before any scan."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators.lookups import latest_per_key


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, modified, bytes of the files under a folder; their contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def parse_names(df: DataFrame, column: Column, template: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """Fields of file names by a template like "{mission}_{start:timestamp}_{stop:timestamp}_{version}.nc". Timestamps are
    yyyyMMdd'T'HHmmss; a field goes up to the next literal. Names that do not fit have NULL fields."""
    fields = re.findall(r"\{(\w+)(?::(\w+))?\}", template)
    literal = re.split(r"\{\w+(?::\w+)?\}", template)
    expression = "^" + "".join(re.escape(literal[i]) + "(.+?)" for i in range(len(fields))) + re.escape(literal[-1]) + "$"
    name = F.regexp_extract(column, r"([^/]+)$", 1)
    out = {}
    for i, (field, kind) in enumerate(fields, 1):
        text = F.nullif(F.regexp_extract(name, expression, i), F.lit(""))
        kind = (types or {}).get(field, kind)
        if kind == "timestamp":
            value = F.try_to_timestamp(F.regexp_extract(text, r"(\d{8}T\d{6})", 1), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")
        elif kind:
            value = text.try_cast(kind)
        else:
            value = text
        out[field] = value
    return df.withColumns(out)


def overlapping(df: DataFrame, start: str, stop: str, first, last) -> DataFrame:
    """Files whose time range overlaps the period."""
    return df.filter((F.col(start) <= F.lit(last)) & (F.col(stop) >= F.lit(first)))


def contained(df: DataFrame, start: str, stop: str, first, last) -> DataFrame:
    return df.filter((F.col(start) >= F.lit(first)) & (F.col(stop) <= F.lit(last)))


def newest_versions(df: DataFrame, key: Sequence[str], created: str) -> DataFrame:
    """Of files with the same key (a start time) the one that was created last; ties by path."""
    order = [F.desc_nulls_last(created)] + ([F.asc("path")] if "path" in df.columns else [])
    return latest_per_key(df, key, order)


def closest_dates(days: Sequence[int] = (7,)) -> list[int]:
    """Day offsets in the order of search: 0, -1, 1, -2, 2, ..."""
    out = [0]
    for k in range(1, max(days) + 1):
        out += [-k, k]
    return out


def polar_ocean_files(summary: DataFrame, min_latitude: float, hemisphere: str | None = None, least_ocean: float = 1e-6) -> DataFrame:
    """Files worth reading, from their metadata alone."""
    top = F.greatest(F.abs("lat_min"), F.abs("lat_max"))
    ok = (F.col("open_ocean_percent") > least_ocean) & (top >= min_latitude)
    if hemisphere == "north":
        ok = ok & (F.col("lat_max") > 0)
    elif hemisphere == "south":
        ok = ok & (F.col("lat_min") < 0)
    return summary.filter(ok)


def xml_fields(text: Column, schema: str) -> Column:
    return F.from_xml(text, schema)


HEMISPHERES = ("north", "south", "global", "nh", "sh")


def detect_version(files: DataFrame, base: str) -> str | None:
    """The version folder right under the base folder: None if there is no folder but those of hemispheres. Several are an
    error, as one of them has to be named."""
    top = F.regexp_extract("path", "^" + re.escape(base.rstrip("/")) + "/([^/]+)/", 1)
    found = files.select(top.alias("v")).filter((F.col("v") != "") & ~F.col("v").isin(*HEMISPHERES)).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"several versions under {base}: {sorted(r['v'] for r in found)}, name one")
    return found[0]["v"] if found else None


def period_files(files: DataFrame, base: str, hemisphere: str, first, last, version: str | None = None, start: str = "start", stop: str = "stop") -> DataFrame:
    """Files below base[/version]/hemisphere/yyyy/mm that overlap a period. Files are stored by the month they start in, so the
    month before the period is looked at as well: only those folders, then the times."""
    folder = "/".join([base.rstrip("/"), *([version] if version else []), hemisphere])
    month = F.regexp_extract("path", "^" + re.escape(folder) + r"/(\d{4}/\d{2})/", 1)
    low, high = (F.date_format(F.add_months(F.lit(x).cast("date"), k), "yyyy/MM") for x, k in ((first, -1), (last, 0)))
    return overlapping(files.filter((month >= low) & (month <= high)), start, stop, F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))


def day_files(files: DataFrame, day, start: str = "start", stop: str = "stop") -> DataFrame:
    """Files that hold records of a day: started on it, or on the day before and not over at midnight."""
    at = F.lit(day).cast("date")
    begins = F.to_date(F.col(start))
    return files.filter((begins == at) | ((begins == F.date_sub(at, 1)) & (F.to_date(F.col(stop)) >= at)))
