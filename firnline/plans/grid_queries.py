"""Grid aggregates, statistics, masks and flags over events and order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions.geodesy import Grid, grid_cells, laea_polar, with_cell
from firnline.functions.vocab import SURFACE_TYPES
from firnline.operators import grid as G
from firnline.plans.tables import EVENTS, SURFACE_SQL, load, rounded, surface_of_line

DAY_SQL = "strftime(ts, '%Y-%m-%d')"


def _cells(spark, sf_dir) -> DataFrame:
    """Events in cells of 25 units by day."""
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return e.withColumns({"day": F.date_format("ts", "yyyy-MM-dd"), "cell": F.floor(F.col("value") / 25).cast("long")})


def _lines(spark, sf_dir) -> DataFrame:
    """Order lines in cells (ship month, quantity by tens) with a surface type."""
    li = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return li.withColumns({
        "yj": (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("long"), "xi": F.floor(F.col("l_quantity") / 10).cast("long"),
        "surface": surface_of_line(F.col("l_returnflag"), F.col("l_linestatus")),
    })


def grid_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cells(spark, sf_dir).groupBy("day", "cell").agg(F.count("value").alias("n"), F.when(F.count("value") >= 2, F.avg("value")).alias("value_mean"))
    return rounded(out)


def grid_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _cells(spark, sf_dir)
    e = e.select("day", "cell", F.col("value").alias("mean"), F.col("value").alias("mid"), F.col("value").alias("top"), F.col("user_id").cast("double").alias("only"), F.col("value").alias("unc"))
    methods = {"mean": "average", "mid": "median", "top": "max", "only": "unique", "unc": "average_uncertainty", "absent": "average"}
    return rounded(G.grid_parameters(e, methods, 2, ("day", "cell")))


def surface_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir).withColumn("sit", F.col("l_discount") - 0.05)
    return rounded(li.groupBy("yj", "xi").agg(*[c.alias(k) for k, c in G.surface_statistics(F.col("surface"), F.col("sit")).items()]))


def classifier_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = G.classifier_statistics(["power", "noise"], ["mean", "sdev"], F.col("surface"), ["all", "lead", "sea_ice"])
    lines = _lines(spark, sf_dir).withColumns({"power": F.col("l_extendedprice") * 0.318309886, "noise": F.col("l_tax") * 0.318309886})
    return rounded(lines.groupBy("yj", "xi").agg(*[c.alias(k) for k, c in stats.items()]), 4)


def temporal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return rounded(G.temporal_coverage(e, day, F.col("event_type") != "click", 400, ["user_id"]))


def inverse_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _lines(spark, sf_dir).groupBy("yj", "xi").agg(G.inverse_variance(F.col("l_tax"), 0.001, 0.02).alias("unc"), G.valid_count(F.col("l_tax")).alias("n"))
    return rounded(out)


def grid_uncertainties(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _lines(spark, sf_dir).groupBy("yj", "xi").agg(
        F.avg(F.lit(880.0) + F.col("l_tax") * 400).alias("sea_ice_density"), F.avg(F.lit(10.0) + F.col("l_discount")).alias("sea_ice_density_uncertainty"),
        F.avg(F.col("l_discount") * 4).alias("snow_depth"), F.avg(F.col("l_tax") + 0.01).alias("snow_depth_uncertainty"),
        F.avg(F.lit(300.0) + F.col("l_quantity")).alias("snow_density"), F.avg(F.col("l_quantity") + 20).alias("snow_density_uncertainty"),
        F.avg(F.col("l_discount") * 3).alias("sea_ice_freeboard"), F.avg(F.col("l_quantity") / 15).alias("sea_ice_thickness"),
        G.inverse_variance(F.col("l_tax")).alias("radar_freeboard_l3_uncertainty"),
    )
    new = G.grid_uncertainties()
    return rounded(c.select("yj", "xi", *[x.alias(k) for k, x in new.items()]))


def parameter_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir).groupBy("yj", "xi").agg(F.avg("l_tax").alias("tax"), F.avg("l_discount").alias("discount"), F.count("*").cast("int").alias("n"))
    out = G.mask_parameters(li, "discount", "is_nan; is_smaller", ["tax", "n"], "or", 0.05)
    return rounded(out)


def status_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir)
    stats = G.surface_statistics(F.col("surface"))
    c = li.groupBy("yj", "xi").agg(
        *[x.alias(k) for k, x in stats.items()], F.avg(F.when(F.col("l_tax") > 0.04, F.col("l_quantity") / 10)).alias("sit"),
        (F.avg("l_discount") * 1600).alias("sic"), (F.avg("l_quantity") + F.lit(60.0)).alias("lat"),
    )
    status = G.status_flag(F.col("sic"), F.col("lat"), F.col("xi") == 3, F.col("n_valid_waveforms"), F.col("sit"), 70.0, 88.0)
    rules = {
        "n_waveforms": {"source": "n_total_waveforms", "threshold": [10, 30], "target": [2, 1]},
        "lead_fraction": {"source": "lead_fraction", "threshold": 0.2, "target": 2},
        "snow_valid": {"source": "xi", "target": 1},
    }
    quality = G.quality_flag(F.col("sit"), rules)
    return c.select("yj", "xi", status.cast("int").alias("status"), quality.cast("int").alias("quality"))


def neighbourhood_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _lines(spark, sf_dir).groupBy("yj", "xi").agg(F.max("l_tax").alias("tax"), F.sum("l_quantity").alias("quantity"))
    out = G.neighbourhood(c, "quantity", "around", 1, "max")
    return rounded(out)


def neighbourhood_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from firnline.operators.sealevel import smooth_grid

    c = _lines(spark, sf_dir).groupBy("yj", "xi").agg(F.sum("l_quantity").alias("quantity"))
    return rounded(smooth_grid(c, "quantity", "smooth"))


def equal_area_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = Grid("nh", "north", 0.0, 10_800_000.0, 10_800_000.0, 100_000.0, 100_000.0)
    e = load(spark, sf_dir, "events").select((F.col("event_id") % 360 - 180).cast("double").alias("longitude"), (F.lit(50.0) + F.pmod(F.col("event_id") * 7, F.lit(3999)) / 100.0).alias("latitude"), "value")
    return rounded(with_cell(e, grid).filter("xi is not null").groupBy("yj", "xi").agg(F.count("*").alias("n"), F.avg("value").alias("value_mean")))


def projected_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"), (F.lit(-90.0) + F.col("c_custkey") % 41).alias("lat"))
    x, y = laea_polar(F.col("lon"), F.col("lat"), "south")
    return c.select("c_custkey", F.round(x / 1000, 3).alias("x_km"), F.round(y / 1000, 3).alias("y_km"))


def dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = Grid("small", "north", 0.0, 400.0, 300.0, 25.0, 25.0)
    e = load(spark, sf_dir, "events").select((F.col("user_id") % 12).cast("int").alias("yj"), F.least(F.floor(F.col("value") / 25), F.lit(40)).cast("int").alias("xi"), "value")
    cells = G.grid_parameters(e, {"value": "average"}, 2)
    return rounded(G.densify(cells, grid_cells(spark, grid)))


def stack_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.stack_metadata(load(spark, sf_dir, "events"), "event_type", "ts")


QUERIES = {
    f.__name__: f
    for f in (
        grid_average, grid_methods, surface_statistics, classifier_statistics, temporal_coverage, inverse_variance, grid_uncertainties, parameter_mask,
        status_quality, neighbourhood_max, neighbourhood_mean, equal_area_cells, projected_positions, dense_grid, stack_metadata,
    )
}

_S = SURFACE_TYPES
_LINES = f"lines as (select *, cast(year(l_shipdate) * 12 + month(l_shipdate) as bigint) as yj, cast(floor(l_quantity / 10) as bigint) as xi, {SURFACE_SQL} as surface from lineitem)"
_LEAD = "coalesce(count(*) filter (surface = 2) * 1.0 / nullif(count(*) filter (surface in (1, 2, 4)), 0), 0.0)"
_STAT = lambda p, t, cond: (
    f"round(case when count(*) filter ({cond}) >= 2 then avg({p}) filter ({cond}) end, 4) + 0.0 as stat_{p}_{t}_mean, "
    f"round(case when count(*) filter ({cond}) >= 2 then stddev_pop({p}) filter ({cond}) end, 4) + 0.0 as stat_{p}_{t}_sdev"
)
_E = "0.08181919084262157"
_Q = lambda s: f"((1 - {_E} * {_E}) * ({s} / (1 - {_E} * {s} * {_E} * {s}) + (1 / (2 * {_E})) * (ln((1 + {_E} * {s}) / (1 - {_E} * {s})))))"

SQL = {
    "grid_average": f"""
        select {DAY_SQL} as day, cast(floor(value / 25) as bigint) as cell, count(value) as n,
               round(case when count(value) >= 2 then avg(value) end, 6) + 0.0 as value_mean from events group by 1, 2
    """,
    "grid_methods": f"""
        select {DAY_SQL} as day, cast(floor(value / 25) as bigint) as cell, round(case when count(value) >= 2 then avg(value) end, 6) + 0.0 as mean,
               round(case when count(value) >= 2 then median(value) end, 6) + 0.0 as mid, round(case when count(value) >= 2 then max(value) end, 6) + 0.0 as top,
               round(case when count(user_id) >= 2 and min(user_id) = max(user_id) then cast(min(user_id) as double) end, 6) + 0.0 as only,
               round(case when count(value) >= 2 and sum(value) > 0 then sqrt(1.0 / sum(value)) end, 6) + 0.0 as unc, cast(null as double) as absent
        from events group by 1, 2
    """,
    "surface_statistics": f"""
        with {_LINES}
        select yj, xi, count(*) as n_total_waveforms, count(*) filter (surface in (1, 2, 4)) as n_valid_waveforms,
               round(count(*) filter (surface in (1, 2, 4)) * 1.0 / count(*), 6) + 0.0 as valid_fraction, round({_LEAD}, 6) + 0.0 as lead_fraction,
               round({_LEAD.replace('surface = 2', 'surface = 4')}, 6) + 0.0 as seaice_fraction, round({_LEAD.replace('surface = 2', 'surface = 1')}, 6) + 0.0 as ocean_fraction,
               count(*) filter (surface = 7) > 0 as is_land,
               round(count(*) filter (surface = 4 and l_discount - 0.05 < 0) * 1.0 / nullif(count(*) filter (surface = 4), 0), 6) + 0.0 as negative_thickness_fraction
        from lines group by 1, 2
    """,
    "classifier_statistics": f"""
        with {_LINES}, c as (select *, l_extendedprice * 0.318309886::double as power, l_tax * 0.318309886::double as noise from lines)
        select yj, xi, {", ".join(_STAT(p, t, c) for p in ("power", "noise") for t, c in (("all", "true"), ("lead", "surface = 2"), ("sea_ice", "surface = 4")))}
        from c group by 1, 2
    """,
    "temporal_coverage": """
        with d as (select user_id, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as double) as d, count(*) as k from events where event_type <> 'click' group by 1, 2),
        c as (select *, sum(k) over (partition by user_id order by d) as upto, sum(k) over (partition by user_id) as n from d)
        select user_id, round(1 - max(greatest(upto * 1.0 / n - d / 400, d / 400 - (upto - k) * 1.0 / n)), 6) + 0.0 as temporal_coverage_uniformity_factor,
               round(count(distinct d) / 400.0, 6) + 0.0 as temporal_coverage_day_fraction, round((max(d) - min(d) + 1) / 400.0, 6) + 0.0 as temporal_coverage_period_fraction,
               round(sum(d * k) / sum(k) / 400, 6) + 0.0 as temporal_coverage_weighted_center
        from c group by 1
    """,
    "inverse_variance": f"""
        with {_LINES} select yj, xi, round(case when count(*) filter (l_tax > 0) > 0 then greatest(least(1.0 / sqrt(sum(1.0 / (l_tax * l_tax)) filter (l_tax > 0)), 0.02), 0.001) end, 6) + 0.0 as unc,
               count(l_tax) as n from lines group by 1, 2
    """,
    "grid_uncertainties": f"""
        with {_LINES}, c as (
            select yj, xi, avg(880.0 + l_tax * 400) as rho, avg(10.0 + l_discount) as u_rho, avg(l_discount * 4) as sd, avg(l_tax + 0.01) as u_sd,
                   avg(300.0 + l_quantity) as rs, avg(l_quantity + 20) as u_rs, avg(l_discount * 3) as frb,
                   case when count(*) filter (l_tax > 0) > 0 then 1.0 / sqrt(sum(1.0 / (l_tax * l_tax)) filter (l_tax > 0)) end as u_r
            from lines group by 1, 2
        ), f as (select *, sqrt(0.22 * u_sd * 0.22 * u_sd + u_r * u_r) as uf, 1024.0 - rho as d from c),
        s as (select *, case when uf is not null then least(sqrt((1024.0 / d * uf) ** 2 + ((frb * 1024.0 + sd * rs) / (d * d) * u_rho) ** 2 + (rs / d * u_sd) ** 2 + (sd / d * u_rs) ** 2), 10.0) end as us from f)
        select yj, xi, round(uf, 6) + 0.0 as sea_ice_freeboard_l3_uncertainty, round(us, 6) + 0.0 as sea_ice_thickness_l3_uncertainty,
               round(sqrt(us * us + uf * uf), 6) + 0.0 as sea_ice_draft_l3_uncertainty from s
    """,
    "parameter_mask": f"""
        with {_LINES}, c as (select yj, xi, avg(l_tax) as tax, avg(l_discount) as discount, cast(count(*) as integer) as n from lines group by 1, 2)
        select yj, xi, round(case when discount is null or discount < 0.05 then null else tax end, 6) + 0.0 as tax, round(discount, 6) + 0.0 as discount,
               cast(case when discount is null or discount < 0.05 then -1 else n end as integer) as n from c
    """,
    "status_quality": f"""
        with {_LINES}, c as (
            select yj, xi, count(*) as n, count(*) filter (surface in (1, 2, 4)) as nv, {_LEAD} as lf, avg(case when l_tax > 0.04 then l_quantity / 10 end) as sit,
                   avg(l_discount) * 1600 as sic, avg(l_quantity) + 60.0 as lat from lines group by 1, 2
        )
        select yj, xi, case when sit is not null then 5 when nv > 0 and sic >= 70 and xi <> 3 then 4 when xi = 3 then 2 when abs(lat) > 87 then 1 when sic < 70 then 3 else 0 end as status,
               case when sit is null then 3 else greatest(case when n < 10 then 2 when n < 30 then 1 else 0 end, case when lf <= 0.2 then 2 else 0 end, case when xi < 1 then 1 else 0 end) end as quality
        from c
    """,
    "neighbourhood_max": f"""
        with {_LINES}, c as (select yj, xi, max(l_tax) as tax, sum(l_quantity) as quantity from lines group by 1, 2)
        select a.yj, a.xi, round(a.tax, 6) + 0.0 as tax, round(a.quantity, 6) + 0.0 as quantity, round(max(b.quantity), 6) + 0.0 as around
        from c a join c b on abs(a.yj - b.yj) <= 1 and abs(a.xi - b.xi) <= 1 group by 1, 2, 3, 4
    """,
    "neighbourhood_mean": f"""
        with {_LINES}, c as (select yj, xi, sum(l_quantity) as quantity from lines group by 1, 2)
        select a.yj, a.xi, round(a.quantity, 6) + 0.0 as quantity, round(avg(b.quantity), 6) + 0.0 as smooth
        from c a join c b on abs(a.yj - b.yj) <= 1 and abs(a.xi - b.xi) <= 1 group by 1, 2, 3
    """,
    "equal_area_cells": f"""
        with p as (select event_id % 360 - 180 as lon, radians(50.0 + (event_id * 7 % 3999) / 100.0) as phi, value from events),
        r as (select *, 6378137.0 * sqrt(greatest({_Q('1.0')} - {_Q('sin(phi)')}, 0)) as rho from p),
        x as (select rho * sin(radians(lon)) as x, -rho * cos(radians(lon)) as y, value from r),
        c as (select cast(floor((y + 5400000.0) / 100000.0) as integer) as yj, cast(floor((x + 5400000.0) / 100000.0) as integer) as xi, value from x)
        select yj, xi, count(*) as n, round(avg(value), 6) + 0.0 as value_mean from c where yj between 0 and 107 and xi between 0 and 107 group by 1, 2
    """,
    "projected_positions": f"""
        with p as (select c_custkey, c_custkey % 360 - 180 as lon, radians(-90.0 + c_custkey % 41) as phi from customer),
        r as (select *, 6378137.0 * sqrt(greatest({_Q('1.0')} + {_Q('sin(phi)')}, 0)) as rho from p)
        select c_custkey, round(rho * sin(radians(lon)) / 1000, 3) as x_km, round(rho * cos(radians(lon)) / 1000, 3) as y_km from r
    """,
    "dense_grid": """
        with c as (select cast(user_id % 12 as integer) as yj, cast(least(floor(value / 25), 40) as integer) as xi, case when count(value) >= 2 then avg(value) end as value from events group by 1, 2),
        g as (select cast(y as integer) as yj, cast(x as integer) as xi, (x + 0.5) * 25.0 - 200.0 as xc, (y + 0.5) * 25.0 - 150.0 as yc from range(12) a(y), range(16) b(x))
        select yj, xi, round(cast(xc as double), 6) + 0.0 as xc, round(cast(yc as double), 6) + 0.0 as yc, round(value, 6) + 0.0 as value from g left join c using (yj, xi)
    """,
    "stack_metadata": """
        select array_to_string(list_sort(list_distinct(list(event_type))), ',') as missions, min(ts) as start_time, max(ts) as stop_time from events
    """,
}
