"""The input tables as trajectories and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators.windows import Track

EVENTS = Track("user_id", ["ts", "event_id"])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, and a negative zero made positive."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c, t in df.dtypes if t == "double"})


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("user_id", "event_id", "ts", *columns)


def surface_of_line(flag: Column, status: Column) -> Column:
    """A surface type for order lines: returned (R) sea ice, accepted (A) lead, open lines ocean, else unknown."""
    return F.when(flag == "R", 4).when(flag == "A", 2).when(status == "O", 1).otherwise(0).cast("tinyint")


SURFACE_SQL = "case when l_returnflag = 'R' then 4 when l_returnflag = 'A' then 2 when l_linestatus = 'O' then 1 else 0 end"
