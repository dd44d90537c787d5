"""Waveform features and retrackers over the embeddings, taken as echo power by their magnitude."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions import waveform as V
from firnline.operators import retrack as T
from firnline.operators import sealevel as S
from firnline.plans.tables import EVENTS, events, load, rounded


def _echoes(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("w"))


def echo_peakiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("w")
    return rounded(_echoes(spark, sf_dir).select("vec_id", V.peak(w).alias("peak"), V.peak_index(w).alias("peak_at"), V.peakiness(w).alias("peakiness"), V.peakiness(w, 5, 83).alias("skipped"), V.peak_power_db(w).alias("db")))


def echo_ocog(spark: SparkSession, sf_dir: str) -> DataFrame:
    amplitude, width = V.ocog(F.col("w"))
    raw = [c.alias(f"raw_{k}") for k, c in zip(("centre", "amplitude", "width"), V.ocog_properties(F.col("w")))]
    return rounded(_echoes(spark, sf_dir).select("vec_id", amplitude.alias("amplitude"), width.alias("width"), *raw))


def echo_late_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_echoes(spark, sf_dir).select("vec_id", V.late_tail_to_peak(F.col("w"), 10, 20).alias("ltpp"), V.thermal_noise(F.col("w")).alias("noise")))


def echo_leading_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = V.leading_edge(F.col("w"), 0.5, 6, 4)
    df = _echoes(spark, sf_dir).select("vec_id", "w", *[c.alias(k) for k, c in edge.items()])
    return rounded(df.withColumn("leading_edge_peakiness", V.leading_edge_peakiness(F.col("w"), F.col("first_maximum_index"), 3)).drop("w"))


def echo_trailing_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _echoes(spark, sf_dir).withColumn("at", V.peak_index(F.col("w")))
    return rounded(df.select("vec_id", *[c.alias(k) for k, c in V.trailing_edge_slope(F.col("w"), F.col("at"), 0.05).items()]))


def echo_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = V.reduce_bins(F.col("w"), 32)
    return rounded(_echoes(spark, sf_dir).select("vec_id", F.size(short).alias("n_short"), V.total(short).alias("sum_short"), F.size(V.pad_power(F.col("w"), 96)).alias("n_long")))


def echo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = V.window_ranges(F.lit(0.0048) + F.col("vec_id") * 1e-9, 64)
    df = _echoes(spark, sf_dir).withColumn("r", r)
    at, rng = V.ocog_retrack(F.col("w"), F.col("r"), 0.5)
    longer = V.pad_range(F.col("r"), 80)
    return rounded(df.select("vec_id", F.get("r", F.lit(0)).alias("first"), F.element_at(longer, -1).alias("last"), at.alias("ocog_bin"), rng.alias("ocog_range")), 5)


def _retrack_input(spark, sf_dir) -> DataFrame:
    df = _echoes(spark, sf_dir).withColumn("r", V.window_ranges(F.lit(0.0048), 64))
    return df.withColumns({"mode": (F.col("vec_id") % 3).cast("int"), "valid": F.lit(True)})


OPTIONS = T.FirstMaximum(range_bias=(0.0, -0.022, 0.047), uncertainty=0.1)


def first_maximum_retracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    udf = T.first_maximum_retracker(OPTIONS)
    return rounded(_retrack_input(spark, sf_dir).select("vec_id", udf("w", "r", "mode", "valid", F.lit(0.5)).alias("t")).select("vec_id", "t.*"), 5)


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    udf = T.threshold_sweep([0.3, 0.5, 0.7], OPTIONS)
    return rounded(_retrack_input(spark, sf_dir).select("vec_id", F.posexplode(udf("w", "r", "mode", "valid")).alias("k", "range")), 5)


def threshold_freeboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freeboards of several thresholds and the leading edge's width."""
    df = _retrack_input(spark, sf_dir).withColumns({
        "waveform_power": F.col("w"), "waveform_range": F.col("r"), "radar_mode": F.col("mode"), "is_valid": F.col("valid"), "altitude": F.lit(719500.0) + F.col("vec_id") % 50,
        "total_range_correction": F.col("vec_id") % 3 * 0.1, "mean_sea_surface": F.col("vec_id") % 7 * 1.5, "sea_level_anomaly": F.col("vec_id") % 5 * 0.01,
        "snow_geometric_correction": F.when(F.col("vec_id") % 4 > 0, F.lit(0.05)),
    })
    out = T.multi_threshold_freeboards(df, [0.4, 0.6], OPTIONS)
    return rounded(out.select("vec_id", F.get("threshold_freeboards", F.lit(0)).alias("low"), F.get("threshold_freeboards", F.lit(1)).alias("high")), 5)


def lead_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _retrack_input(spark, sf_dir).select("vec_id", T.lead_retracker(T.LeadFilter(sigma0_least=1.0))("w", "r", (F.col("vec_id") % 10).cast("double")).alias("t")).select("vec_id", "t.*")


def trailing_edge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _retrack_input(spark, sf_dir).withColumn("at", V.leading_edge(F.col("w"), 0.5, 6, 0)["first_maximum_index"])
    return df.select("vec_id", "at", T.trailing_edge_fit()("w", "at").alias("t")).select("vec_id", "at", "t.*")


def _along(spark, sf_dir) -> DataFrame:
    df = events(spark, sf_dir, "event_type", "value")
    return df.withColumns({
        "surface_type": F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "click", 4).otherwise(1), "elevation": F.col("value") / 10,
        "mean_sea_surface": F.lit(1.0), "frb": F.col("value") / 100, "lew": F.abs(F.col("value") - 30) / 10,
    })


def sea_level_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.smoothed_linear(_along(spark, sf_dir), EVENTS, S.SeaLevel(filter_window=9, u_dist=10.0, max_dist=15.0))
    return rounded(out.select("event_id", "sea_level_anomaly_raw", "sea_level_anomaly", "sea_level_anomaly_uncertainty", "tie_distance"), 9)


def local_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lowess_smooth(events(spark, sf_dir, "value"), EVENTS, "value", 11).select("event_id", "value_lowess")


def gaussian_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.gaussian_process(events(spark, sf_dir, "value"), EVENTS, "value", 5.0, 10.0).select("event_id", "value_gp")


def deviation_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.deviation_filter(events(spark, sf_dir, "value"), EVENTS, "value", 5, 2.0, 3.0, 1.0, window=11).select("event_id", "kept")


def transition_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _along(spark, sf_dir).withColumns({"sic": F.col("value"), "distance": F.col("event_id") % 5 * 400.0, "spacing": F.lit(300.0)})
    edge = S.IceEdge(ice_width=1200.0, ocean_width=1500.0, smoother_width=2000.0, gradient_least=0.2, edge_width_least=3.0)
    return S.transition_zone(df, EVENTS, "sic", "lew", "frb", "distance", "spacing", edge).select("event_id", F.col("flag_miz").cast("int").alias("flag_miz"))


QUERIES = {
    f.__name__: f
    for f in (
        echo_peakiness, echo_ocog, echo_late_tail, echo_leading_edge, echo_trailing_edge, echo_windows, echo_ranges, first_maximum_retracker, threshold_sweep, threshold_freeboards,
        lead_fit, trailing_edge_fit, sea_level_linear, local_regression, gaussian_process, deviation_filter, transition_zone,
    )
}

_W = "e as (select vec_id, list_transform(embedding, lambda x: abs(cast(x as double))) as w from embeddings)"
_B = "b as (select vec_id, cast(i as integer) as i, w[i + 1] as x from e, range(64) r(i))"
_P = "p as (select vec_id, max(x) as pk, min(case when x = m then i end) as pa from (select *, max(x) over (partition by vec_id) as m from b) group by 1)"
_ORDER = "partition by user_id order by ts, event_id"
_STEP = "(299792458.0::double / 1280000000.0::double)"
#: Oversampled, smoothed and normalised echoes (y over fine bins k, range g), their first maximum f, its power yf and the peak.
_FINE = f"""
    {_W}, x as (select vec_id, cast(k as integer) as k, k * (63.0::double / 639.0::double) as x, w, vec_id % 3 as m from e, range(640) r(k)), j as (select *, cast(least(floor(x), 62) as integer) as i from x),
    o as (select vec_id, m, k, w[i + 1] * (1 - (x - i)) + w[i + 2] * (x - i) as v, 0.0048::double * 149896229.0::double - 32 * {_STEP} + x * {_STEP} as g from j),
    s as (select vec_id, m, k, g, case when m = 2 then sum(v) over (partition by vec_id order by k rows between 25 preceding and 25 following) / 51 else sum(v) over (partition by vec_id order by k rows between 5 preceding and 5 following) / 11 end as v from o),
    q as (select *, v / max(v) over (partition by vec_id) as y, max(v) over (partition by vec_id) as norm from s),
    u as (select *, lag(y, 1, -1e-6) over (partition by vec_id order by k) as y0, lead(y, 1, -1e-6) over (partition by vec_id order by k) as y2, lag(g) over (partition by vec_id order by k) as g0,
                 min(case when y = 1 then k end) over (partition by vec_id) as top, avg(case when k < 50 then y end) over (partition by vec_id) + case when m = 2 then 0.45 else 0.15 end as need from q),
    h as (select vec_id, coalesce(min(k) filter (k <= top and y >= need and y > y0 and (k = top or y > y2)), min(top)) as f from u group by 1),
    z as (select u.*, f, max(case when k = f then y end) over (partition by u.vec_id) as yf, case m when 0 then 0.0 when 1 then -0.022 else 0.047 end::double as bias from u join h using (vec_id))
"""


def _hit(name: str, share: str) -> str:
    """A CTE with the range where the power first exceeds a share of the first maximum's."""
    return f"{name} as (select vec_id, min_by(g0 + ({share} * yf - y0) / (y - y0) * (g - g0), k) as g from z where k >= 50 and k < f and y > {share} * yf group by 1)"


SQL = {
    "first_maximum_retracker": f"""
        with {_FINE}, {_hit('a', '0.5::double')}, {_hit('lo', '0.05::double')}, {_hit('hi', '0.95::double')}, d as (select vec_id, min(f) as f, min(yf) as yf, min(norm) as norm, min(bias) as bias from z group by 1)
        select vec_id, round(a.g - bias, 5) + 0.0 as range, round(case when a.g is not null then 0.5 * yf * norm end, 5) + 0.0 as power, case when a.g is not null then 0.1::double end as uncertainty,
               cast(f // 10 as integer) as first_maximum_index, round(case when hi.g >= lo.g then hi.g - lo.g end, 5) + 0.0 as leading_edge_width
        from d left join a using (vec_id) left join lo using (vec_id) left join hi using (vec_id)
    """,
    "threshold_sweep": f"""
        with {_FINE}, {_hit('a', '0.3::double')}, {_hit('b', '0.5::double')}, {_hit('c', '0.7::double')}, d as (select vec_id, min(bias) as bias from z group by 1)
        select vec_id, cast(n as integer) as k, round(case n when 0 then a.g when 1 then b.g else c.g end - bias, 5) + 0.0 as range from d left join a using (vec_id) left join b using (vec_id) left join c using (vec_id), range(3) t(n)
    """,
    "threshold_freeboards": f"""
        with {_FINE}, {_hit('a', '0.4::double')}, {_hit('b', '0.6::double')}, d as (select vec_id, min(bias) as bias from z group by 1),
        t as (select vec_id, 719500.0::double + vec_id % 50 - vec_id % 3 * 0.1::double - vec_id % 7 * 1.5::double - vec_id % 5 * 0.01::double + case when vec_id % 4 > 0 then 0.05::double else 0 end + bias as base, a.g as a, b.g as b
              from d left join a using (vec_id) left join b using (vec_id))
        select vec_id, round(base - a, 5) + 0.0 as low, round(base - b, 5) + 0.0 as high from t
    """,
    "echo_peakiness": f"""
        with {_W}, {_B}, {_P}, s as (select vec_id, sum(x) as t, sum(x) filter (i >= 5) as t5, max(x) filter (i >= 5) as m5 from b group by 1)
        select vec_id, round(pk, 6) + 0.0 as peak, pa as peak_at, round(pk / t * 64.0, 6) + 0.0 as peakiness, round(m5 / t5 * 83.0, 6) + 0.0 as skipped, round(10 * log10(pk), 6) + 0.0 as db
        from p join s using (vec_id)
    """,
    "echo_ocog": f"""
        with {_W}, {_B}, n as (select vec_id, avg(x) as n from b where i < 11 group by 1), y as (select vec_id, i, x, greatest(x - n, 0) as y from b join n using (vec_id))
        select vec_id, round(sqrt(sum(y**4) / sum(y**2)), 6) + 0.0 as amplitude, round(sum(y**2) ** 2 / sum(y**4), 6) + 0.0 as width, round(sum((i + 1) * x) / sum(x), 6) + 0.0 as raw_centre, round(sqrt(sum(x * x) / sum(x)), 6) + 0.0 as raw_amplitude, round(sum(x) ** 2 / sum(x * x), 6) + 0.0 as raw_width from y group by 1
    """,
    "echo_late_tail": f"""
        with {_W}, {_B}, {_P}, t as (select vec_id, case when min(pa) + 20 < 64 then avg(x) filter (i between pa + 10 and pa + 20) / min(pk) end as ltpp from b join p using (vec_id) group by 1),
        h as (select vec_id, x, row_number() over (partition by vec_id order by x) as k from b where i < 32), n as (select vec_id, median(x) as noise from h where k between 5 and 13 group by 1)
        select vec_id, round(ltpp, 6) + 0.0 as ltpp, round(noise, 6) + 0.0 as noise from t join n using (vec_id)
    """,
    "echo_leading_edge": f"""
        with {_W}, {_B}, {_P}, q as (select b.vec_id, i, x, x / pk as y, pa, case when i > 4 then lag(x / pk) over w else -1e-6 end as l, case when i < pa then lead(x / pk) over w else -1e-6 end as r from b join p using (vec_id) window w as (partition by b.vec_id order by i)),
        f as (select vec_id, coalesce(min(i) filter (i between 4 and pa and y >= 0.5 and y > l and y > r and pa >= 4), min(pa)) as f0 from q group by 1),
        g as (select vec_id, case when f0 >= 4 then f0 else -1 end as f from f),
        z as (select q.vec_id, g.f, q.i, q.x, q.y, q.y - lag(q.y) over (partition by q.vec_id order by q.i) as d from q join g using (vec_id)),
        a as (select vec_id, min(f) as f, max(y) filter (i = f) as p, sum(greatest(d, 0)) filter (i between greatest(f - 6, 1) and f) + max(y) filter (i = greatest(f - 6, 1)) as g,
                     max(x) filter (i = f) / avg(x) filter (i between greatest(f - 3, 0) and f - 1) * (min(f) - greatest(min(f) - 3, 0)) as lp from z group by 1)
        select vec_id, f as first_maximum_index, round(case when f >= 0 then p end, 6) + 0.0 as first_maximum_power, round(case when f >= 0 then g / p end, 6) + 0.0 as leading_edge_quality,
               round(case when f > 0 then lp end, 6) + 0.0 as leading_edge_peakiness from a
    """,
    "echo_trailing_edge": f"""
        with {_W}, {_B}, {_P}, q as (select vec_id, i, x / pk as y, pa from b join p using (vec_id)), s as (select vec_id, coalesce(min(i) filter (i > pa and y < 0.05), 64) as stop from q group by 1),
        t as (select vec_id, i, y from q join s using (vec_id) where i >= pa and i < stop)
        select vec_id, round(case when count(t.i) >= 2 then regr_slope(t.y, t.i) end, 6) + 0.0 as trailing_edge_slope,
               round(case when count(t.i) >= 2 and max(t.y) > min(t.y) then corr(t.y, t.i) end, 6) + 0.0 as trailing_edge_correlation
        from s left join t using (vec_id) group by 1
    """,
    "echo_windows": f"""
        with {_W}, {_B}, {_P}
        select vec_id, cast(32 as integer) as n_short, round(sum(x) filter (i >= greatest(least(pa - 12, 32), 0) and i < greatest(least(pa - 12, 32), 0) + 32), 6) + 0.0 as sum_short,
               cast(96 as integer) as n_long from b join p using (vec_id) group by 1
    """,
    "echo_ranges": f"""
        with {_W}, {_B}, f as (select vec_id, (0.0048::double + vec_id * 1e-9::double) * (299792458.0::double / 2) - 32 * {_STEP} as first from e),
        l as (select vec_id, 0.5 * sqrt(sum(x**4) / sum(x**2)) as level from b group by 1), c as (select b.*, level, lag(x) over (partition by b.vec_id order by i) as px from b join l using (vec_id)),
        o as (select vec_id, min(i) as i1 from c where i >= 1 and x > level group by 1), k as (select c.vec_id, i - 1 + (level - px) / (x - px) as bin from c join o on c.vec_id = o.vec_id and c.i = o.i1)
        select vec_id, round(first, 5) + 0.0 as first, round(first + 79 * {_STEP}, 5) + 0.0 as last, round(bin, 5) + 0.0 as ocog_bin, round(first + bin * {_STEP}, 5) + 0.0 as ocog_range from f left join k using (vec_id)
    """,
    "sea_level_linear": f"""
        with p as (select *, row_number() over ({_ORDER}) - 1 as pos, count(*) over (partition by user_id) as n, event_type = 'purchase' as tie,
                          case when event_type = 'purchase' then value / 10 - 1 end as raw from events),
        h as (select *, least(pos, n - 1 - pos, 4) as h from p),
        s1 as (select a.event_id, a.user_id, a.pos, a.n, a.h, a.tie, a.raw, a.ts, case when a.tie then avg(b.raw) end as s1 from h a join h b on a.user_id = b.user_id and b.pos between a.pos - a.h and a.pos + a.h group by a.event_id, a.user_id, a.pos, a.n, a.h, a.tie, a.raw, a.ts),
        g as (select *, last_value(case when s1 is not null then pos end ignore nulls) over b as lp, last_value(s1 ignore nulls) over b as ly,
                     first_value(case when s1 is not null then pos end ignore nulls) over a as rp, first_value(s1 ignore nulls) over a as ry from s1
              window b as ({_ORDER} rows between unbounded preceding and current row), a as ({_ORDER} rows between current row and unbounded following)),
        s2 as (select *, coalesce(case when s1 is not null then s1 when lp is not null and rp is not null then ly + (pos - lp)::double / (rp - lp) * (ry - ly) end, ly, ry) as s2, least(coalesce(pos - lp, n), coalesce(rp - pos, n)) as dist from g),
        s3 as (select a.event_id, a.raw, a.dist, avg(b.s2) as s3 from s2 a join s2 b on a.user_id = b.user_id and b.pos between a.pos - a.h and a.pos + a.h group by 1, 2, 3)
        select event_id, round(raw, 9) + 0.0 as sea_level_anomaly_raw, round(case when dist <= 15 then s3 end, 9) + 0.0 as sea_level_anomaly,
               round(case when dist <= 15 and s3 is not null then 0.02 + 0.08 * pow(least(dist / 10.0, 1.0), 2) end, 9) + 0.0 as sea_level_anomaly_uncertainty, dist as tie_distance from s3
    """,
}
