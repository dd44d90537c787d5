"""Ordered-window operators over the events of each user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators import windows as X
from firnline.plans.tables import EVENTS, events, rounded

GAP = "case when event_type = 'click' then null else value end"


def _gappy(spark, sf_dir) -> DataFrame:
    df = events(spark, sf_dir, "event_type", "value")
    return df.withColumns({"x": F.when(F.col("event_type") != "click", F.col("value")), "pos": EVENTS.position().cast("double")})


def rolling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value")
    return rounded(df.select("event_id", *[c.alias(f"value_{k}") for k, c in X.rolling(EVENTS, F.col("value"), 3).items()]))


def rolling_by_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value").withColumn("w", X.odd_window(F.lit(60.0), F.lit(4.0) + F.col("user_id") % 9))
    return rounded(X.rolling_by_spacing(df, EVENTS, "value", "w").select("event_id", "w", "value_rolling_mean", "value_rolling_sdev"))


def box_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.box_smooth(events(spark, sf_dir, "value"), EVENTS, "value", 9).select("event_id", "value_smooth"))


def fill_gaps_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _gappy(spark, sf_dir)
    return rounded(df.select("event_id", X.fill_gaps(EVENTS, F.col("x"), F.col("pos"), "hold").alias("filled")))


def fill_gaps_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _gappy(spark, sf_dir)
    return rounded(df.select("event_id", X.fill_gaps(EVENTS, F.col("x"), F.col("pos")).alias("filled")))


def fill_gaps_extrapolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.extrapolate_gaps(_gappy(spark, sf_dir), EVENTS, "x", "pos", "filled").select("event_id", "filled"))


def fill_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _gappy(spark, sf_dir)
    return rounded(df.select("event_id", X.fill_nearest(EVENTS, F.col("x"), F.col("pos"), 2).alias("filled")))


def flag_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "event_type").withColumn("pos", EVENTS.position())
    return df.select("event_id", X.flag_distance(EVENTS, F.col("event_type") == "purchase", F.col("pos")).cast("long").alias("distance"))


def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run_lengths(events(spark, sf_dir, "event_type"), EVENTS, "event_type")


def direction_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, "value").select("event_id", X.orbit_flag(EVENTS, F.col("value")).alias("falling"))


def box_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(events(spark, sf_dir, "value").select("event_id", X.box_sum(EVENTS, F.col("value"), 5).alias("smooth")))


def first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "event_type").withColumn("pos", EVENTS.position())
    first, last = X.first_last_index(EVENTS, F.col("event_type") == "purchase", F.col("pos"))
    return df.select("event_id", first.cast("long").alias("first_at"), last.cast("long").alias("last_at"))


QUERIES = {
    f.__name__: f
    for f in (
        rolling_stats, rolling_by_spacing, box_smooth, fill_gaps_hold, fill_gaps_inside, fill_gaps_extrapolate, fill_nearest, flag_distance,
        run_lengths, direction_flag, box_sum, first_last,
    )
}

_ORDER = "partition by user_id order by ts, event_id"
_POS = f"select *, row_number() over ({_ORDER}) - 1 as pos, count(*) over (partition by user_id) as n, {GAP} as x from events"
_NEAR = f"""
    with p as ({_POS}),
    s as (
        select *, last_value(case when x is not null then pos end ignore nulls) over b as lp,
               last_value(x ignore nulls) over b as ly,
               first_value(case when x is not null then pos end ignore nulls) over a as rp,
               first_value(x ignore nulls) over a as ry,
               count(x) over (partition by user_id) as k
        from p
        window b as ({_ORDER} rows between unbounded preceding and current row),
               a as ({_ORDER} rows between current row and unbounded following)
    )
"""
_INSIDE = "case when x is not null then x when lp is not null and rp is not null then ly + (pos - lp) * 1.0 / (rp - lp) * (ry - ly) end"

SQL = {
    "rolling_stats": f"""
        select event_id, round(avg(value) over w, 6) + 0.0 as value_mean, round(stddev_samp(value) over w, 6) + 0.0 as value_sdev
        from events window w as ({_ORDER} rows between 3 preceding and 3 following)
    """,
    "rolling_by_spacing": f"""
        with p as (
            select *, cast(floor(floor(60.0 / (4.0 + user_id % 9)) / 2) * 2 + 1 as integer) as w from ({_POS})
        )
        select a.event_id, a.w, round(avg(b.value), 6) + 0.0 as value_rolling_mean, round(stddev_samp(b.value), 6) + 0.0 as value_rolling_sdev
        from p a join p b on a.user_id = b.user_id and b.pos between a.pos - (a.w - 1) // 2 and a.pos + (a.w - 1) // 2
        group by 1, 2
    """,
    "box_smooth": f"""
        with p as (select *, least(pos, n - 1 - pos, 4) as h from ({_POS}))
        select a.event_id, round(avg(b.value), 6) + 0.0 as value_smooth
        from p a join p b on a.user_id = b.user_id and b.pos between a.pos - a.h and a.pos + a.h group by 1
    """,
    "fill_gaps_hold": f"{_NEAR} select event_id, round(coalesce({_INSIDE}, ly, ry), 6) + 0.0 as filled from s",
    "fill_gaps_inside": f"{_NEAR} select event_id, round(case when k >= 2 then {_INSIDE} else x end, 6) + 0.0 as filled from s",
    "fill_gaps_extrapolate": f"""{_NEAR}, v as (
            select user_id, pos, x, row_number() over (partition by user_id order by pos) as a,
                   row_number() over (partition by user_id order by pos desc) as z from s where x is not null
        ), e as (
            select user_id, max(pos) filter (a = 1) as a1, max(pos) filter (a = 2) as a2, max(x) filter (a = 1) as y1, max(x) filter (a = 2) as y2,
                   max(pos) filter (z = 1) as z1, max(pos) filter (z = 2) as z2, max(x) filter (z = 1) as v1, max(x) filter (z = 2) as v2
            from v group by 1
        )
        select event_id, round(case
            when k = 0 then 0.0
            when lp is not null and rp is not null then {_INSIDE}
            when lp is null then coalesce(y1 + (pos - a1) * 1.0 / (a2 - a1) * (y2 - y1), y1)
            else coalesce(v1 + (pos - z1) * 1.0 / (z2 - z1) * (v2 - v1), v1) end, 6) + 0.0 as filled
        from s left join e using (user_id)
    """,
    "fill_nearest": f"""{_NEAR}
        select event_id, round(case when x is not null then x
            when lp is not null and (rp is null or pos - lp <= rp - pos) then case when pos - lp <= 2 then ly end
            when rp - pos <= 2 then ry end, 6) + 0.0 as filled from s
    """,
    "flag_distance": f"""
        with p as ({_POS}), f as (
            select *, max(case when event_type = 'purchase' then pos end) over ({_ORDER} rows between unbounded preceding and current row) as lp,
                   min(case when event_type = 'purchase' then pos end) over ({_ORDER} rows between current row and unbounded following) as rp
            from p
        )
        select event_id, cast(least(coalesce(pos - lp, n), coalesce(rp - pos, n)) as bigint) as distance from f
    """,
    "run_lengths": f"""
        with p as ({_POS}), c as (
            select *, case when pos = 0 or lag(event_type) over ({_ORDER}) is not distinct from event_type then 0 else 1 end as c from p
        ), i as (select *, cast(sum(c) over ({_ORDER} rows unbounded preceding) as bigint) as island from c)
        select user_id, island, min(event_type) as value, cast(min(pos) as bigint) as start, count(*) as length from i group by 1, 2
    """,
    "direction_flag": f"""
        select event_id, case when coalesce(value - lag(value) over ({_ORDER}), lead(value) over ({_ORDER}) - value) < 0 then 1 else 0 end as falling
        from events
    """,
    "box_sum": f"""
        select event_id, round(coalesce(sum(value) over ({_ORDER} rows between 2 preceding and 2 following), 0) / 5.0, 6) + 0.0 as smooth from events
    """,
    "first_last": f"""
        with p as ({_POS})
        select event_id, cast(min(case when event_type = 'purchase' then pos end) over (partition by user_id) as bigint) as first_at,
               cast(max(case when event_type = 'purchase' then pos end) over (partition by user_id) as bigint) as last_at from p
    """,
}
