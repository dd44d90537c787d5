"""Record sources: declared column mappings, block flattening, unit conversion, patches and unions of products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions.vocab import missing_to_null
from firnline.functions.geodesy import wrap_longitude


def scan(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str] | None = None, fills: Mapping | None = None) -> DataFrame:
    """Parquet records with NaN (and fills) as NULL. columns: target name -> source name; a source that does not exist is
    a NULL column."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.option("mergeSchema", "true").parquet(*paths) if len(paths) > 1 else spark.read.parquet(paths[0])
    if columns:
        df = rename(df, columns)
    return missing_to_null(df, dict(fills or {}))


def rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[(F.col(s) if s.split(".")[0] in df.columns else F.lit(None).cast("double")).alias(t) for t, s in columns.items()])


def union_products(products: Sequence[DataFrame]) -> DataFrame:
    """Products of several platforms by name; columns that one lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), products)


def flatten_blocks(df: DataFrame, arrays: Sequence[str], repeat: Sequence[str], index: str = "record_idx") -> DataFrame:
    """One row per element of the block's arrays; scalar columns repeat."""
    zipped = F.arrays_zip(*[F.col(a).alias(a) for a in arrays])
    return df.select(*repeat, F.posexplode(zipped).alias(index, "__e")).select(*repeat, index, *[F.col(f"__e.{a}").alias(a) for a in arrays])


def patch(df: DataFrame, sibling: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns replaced by those of a sibling product where it has the record."""
    right = sibling.select(*key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(right, list(key), "left")
    have = set(df.columns)
    return out.select(
        *[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns], *[F.col(f"__{c}").alias(c) for c in columns if c not in have]
    )


def add_regional(df: DataFrame, sibling: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """A regional term added on top of a column where there is one."""
    out = df.join(sibling.select(*key, F.col(column).alias("__more")), list(key), "left")
    return out.withColumn(column, F.col(column) + F.coalesce("__more", F.lit(0.0))).drop("__more")


def valid_measurement(confidence: Column, low: int = 0, high: int = 4096) -> Column:
    return confidence.between(low, high)


# Dates from which the count of leap seconds (TAI - UTC) holds.
LEAP_SECONDS = (
    ("1990-01-01", 25), ("1991-01-01", 26), ("1992-07-01", 27), ("1993-07-01", 28), ("1994-07-01", 29), ("1996-01-01", 30),
    ("1997-07-01", 31), ("1999-01-01", 32), ("2006-01-01", 33), ("2009-01-01", 34), ("2012-07-01", 35), ("2015-07-01", 36),
    ("2017-01-01", 37),
)


def tai_to_utc(tai: Column) -> Column:
    """A TAI timestamp in UTC."""
    offset = F.lit(0)
    for day, seconds in LEAP_SECONDS:
        offset = F.when(tai >= F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(seconds)), F.lit(seconds)).otherwise(offset)
    return tai - F.make_dt_interval(secs=offset)


def clean_position(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Longitudes wrapped to [-180, 180); impossible positions NULL."""
    ok = F.abs(F.col(lat)) <= 90
    return df.withColumns({lon: F.when(ok & (F.abs(F.col(lon)) <= 360), wrap_longitude(F.col(lon))), lat: F.when(ok, F.col(lat))})


def daily_merge(parts: Sequence[DataFrame], required: str = "sea_ice_freeboard") -> DataFrame:
    """All records of a day with a finite required parameter."""
    return union_products(parts).filter(F.col(required).isNotNull())
