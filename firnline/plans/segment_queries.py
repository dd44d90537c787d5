"""Segmentation operators over the events of each user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators import segments as S
from firnline.operators.windows import Track
from firnline.plans.tables import EVENTS, events, rounded

SIX_HOURS = 6 * 3600.0


def split_time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = S.split_at_time_gaps(events(spark, sf_dir), EVENTS, "ts", SIX_HOURS)
    return parts.groupBy("user_id", "part").agg(F.count("*").alias("n"), F.min("ts").alias("start_ts"), F.max("ts").alias("stop_ts"))


def split_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_by_change(events(spark, sf_dir, "event_type"), EVENTS, "event_type").select("event_id", "part")


def polar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value").withColumn("lat", F.col("value") - 50)
    return S.polar_parts(df, EVENTS, "lat", 20.0).groupBy("user_id", "part").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def hemispheres(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value").withColumn("lat", F.col("value") - 50)
    return S.split_hemispheres(df, "lat", 20.0).groupBy("user_id", "hemisphere").agg(F.count("*").alias("n"))


def small_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "event_type").withColumn("surface", F.when(F.col("event_type") == "view", 1).otherwise(7))
    return S.small_runs_to_land(df, EVENTS, F.col("surface") == 1, 2, F.lit(7), "surface").select("event_id", "surface")


def trim_to_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.trim_to(events(spark, sf_dir, "event_type"), EVENTS, F.col("event_type") == "purchase").select("event_id", "user_id")


def split_long_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value")
    return S.split_at_long_runs(df, EVENTS, F.col("value") < 60, 2).select("event_id", "part")


def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value", "event_type").withColumns({
        "latitude": F.col("value") - 50, "longitude": F.col("value") * 2, "mode": (F.col("event_id") % 3).cast("int"),
        "surface": F.when(F.col("event_type") == "view", 1).otherwise(7),
    })
    return rounded(S.segment_summary(df, Track("user_id", ["ts", "event_id"]), "ts", mode="mode", surface="surface"))


def connected_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir, "event_type").groupBy("event_type", "user_id").agg(F.min("ts").alias("start_time"), F.max("ts").alias("stop_time"))
    out = S.connect_segments(spans, "event_type", 3600.0)
    return out.groupBy("event_type", "chain").agg(F.count("*").alias("n"), F.min("start_time").alias("start_time"), F.max("stop_time").alias("stop_time"))


def append_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir).withColumn("part", F.col("event_id") % 2)
    return S.append_without_overlap(df, "user_id", "part", "ts").select("event_id", "user_id", "part")


def enough_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.enough_records(events(spark, sf_dir), EVENTS, 8).select("event_id", "user_id")


def fill_time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.fill_time_gaps(events(spark, sf_dir, "value"), EVENTS, "ts", ["value"])
    return out.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("is_inserted").alias("n_inserted"), F.round(F.sum("value"), 3).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        split_time_gaps, split_by_change, polar_parts, hemispheres, small_runs, trim_to_flagged, split_long_runs, segment_summary, connected_chains,
        append_overlap, enough_records, fill_time_gaps,
    )
}

_ORDER = "partition by user_id order by ts, event_id"


def _runs(condition: str, extra: str = "") -> str:
    """Events with cond, and the length of each run of equal cond."""
    return f"""
        c0 as (select *, {condition} as cond{extra} from events),
        c1 as (select *, case when row_number() over ({_ORDER}) = 1 or lag(cond) over ({_ORDER}) is not distinct from cond then 0 else 1 end as ch from c0),
        c2 as (select *, sum(ch) over ({_ORDER} rows unbounded preceding) as run from c1),
        r as (select *, count(*) over (partition by user_id, run) as len from c2)
    """


SQL = {
    "split_time_gaps": f"""
        with g as (select *, case when epoch_us(ts) - lag(epoch_us(ts)) over ({_ORDER}) > {SIX_HOURS} * 1e6 then 1 else 0 end as c from events),
        p as (select *, cast(sum(c) over ({_ORDER} rows unbounded preceding) as bigint) as part from g)
        select user_id, part, count(*) as n, min(ts) as start_ts, max(ts) as stop_ts from p group by 1, 2
    """,
    "split_by_change": f"with {_runs('event_type')} select event_id, cast(run as bigint) as part from r",
    "polar_parts": f"""
        with {_runs('abs(value - 50) >= 20')}
        select user_id, cast(run as bigint) as part, count(*) as n, min(event_id) as first_id from r where cond group by 1, 2
    """,
    "hemispheres": """
        select user_id, case when value - 50 >= 0 then 'north' else 'south' end as hemisphere, count(*) as n
        from events where abs(value - 50) >= 20 group by 1, 2
    """,
    "small_runs": f"""
        with {_runs("event_type = 'view'")} select event_id, case when cond and len >= 2 then 1 else 7 end as surface from r
    """,
    "trim_to_flagged": f"""
        with f as (
            select *, max(case when event_type = 'purchase' then 1 else 0 end) over ({_ORDER} rows between unbounded preceding and current row) as b,
                   max(case when event_type = 'purchase' then 1 else 0 end) over ({_ORDER} rows between current row and unbounded following) as a from events
        ) select event_id, user_id from f where a = 1 and b = 1
    """,
    "split_long_runs": f"""
        with {_runs('coalesce(value < 60, false)')},
        g as (select *, cond and len > 2 as gone from r),
        s as (select *, case when gone and not coalesce(lag(gone) over ({_ORDER}), false) then 1 else 0 end as st from g),
        p as (select *, cast(sum(st) over ({_ORDER} rows unbounded preceding) as bigint) as part from s)
        select event_id, part from p where not gone
    """,
    "segment_summary": """
        select user_id, count(*) as n_records, min(ts) as start_time, max(ts) as stop_time, round(min(value - 50), 6) + 0.0 as lat_min,
               round(max(value - 50), 6) + 0.0 as lat_max, round(min(value * 2), 6) + 0.0 as lon_min, round(max(value * 2), 6) + 0.0 as lon_max,
               round(100.0 * count(*) filter (event_id % 3 = 0) / count(*), 6) + 0.0 as lrm_mode_percent,
               round(100.0 * count(*) filter (event_id % 3 = 1) / count(*), 6) + 0.0 as sar_mode_percent,
               round(100.0 * count(*) filter (event_id % 3 = 2) / count(*), 6) + 0.0 as sin_mode_percent,
               round(100.0 * count(*) filter (event_type = 'view') / count(*), 6) + 0.0 as open_ocean_percent,
               case when round(min(value - 50), 6) > 0 then 'north' when round(max(value - 50), 6) < 0 then 'south' else 'global' end as region_name
        from events group by 1
    """,
    "connected_chains": """
        with s as (select event_type, user_id, min(ts) as start_time, max(ts) as stop_time from events group by 1, 2),
        m as (select *, max(epoch_us(stop_time)) over (partition by event_type order by start_time, stop_time rows between unbounded preceding and 1 preceding) as latest from s),
        c as (select *, sum(case when epoch_us(start_time) - latest <= 3600 * 1e6 then 0 else 1 end) over (partition by event_type order by start_time, stop_time rows unbounded preceding) - 1 as chain from m)
        select event_type, cast(chain as bigint) as chain, count(*) as n, min(start_time) as start_time, max(stop_time) as stop_time from c group by 1, 2
    """,
    "append_overlap": """
        with p as (select *, event_id % 2 as part from events),
        s as (select user_id, max(ts) as stop from p where part = 0 group by 1)
        select event_id, user_id, part from p left join s using (user_id) where part = 0 or stop is null or ts > stop
    """,
    "enough_records": "select event_id, user_id from events qualify count(*) over (partition by user_id) >= 8",
    "fill_time_gaps": f"""
        with d as (select *, epoch_us(ts) / 1e6 as t, lead(epoch_us(ts) / 1e6) over ({_ORDER}) - epoch_us(ts) / 1e6 as dt, lead(value) over ({_ORDER}) as nv from events),
        m as (select user_id, median(dt) as med from d where dt is not null group by 1),
        g as (select d.*, case when dt > med * 1.02 then cast(greatest(round(dt / med) - 1, 0) as integer) else 0 end as k from d left join m using (user_id)),
        i as (select user_id, value + j * 1.0 / (k + 1) * (nv - value) as v from g, unnest(range(1, k + 1)) as u(j) where k > 0),
        a as (select user_id, value as v, 0 as ins from events union all select user_id, v, 1 from i)
        select user_id, count(*) as n, count(*) filter (ins = 1) as n_inserted, round(sum(v), 3) as total from a group by 1
    """,
}
