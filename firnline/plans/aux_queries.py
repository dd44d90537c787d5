"""Radar equations, rule sets from options and auxiliary providers over the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions import radar
from firnline.functions.geodesy import Grid
from firnline.functions.predicates import classify
from firnline.operators.auxiliary import Auxiliary, decode_chart_codes, snow_validity_mask
from firnline.plans.tables import load, rounded

GRID = Grid("coarse", "north", 0.0, 8_000_000.0, 8_000_000.0, 400_000.0, 400_000.0)
OPTIONS = {
    "lrm": {
        "ocean": {"peakiness_max": 3.0, "ice_concentration_min": 5.0},
        "lead": {"sea_ice_backscatter_min": 20.0, "leading_edge_width_max": 6.0, "peakiness_min": [2.0 + 0.5 * m for m in range(12)], "ice_concentration_min": 4.0},
        "sea_ice": {"sea_ice_backscatter_min": 2.0, "sea_ice_backscatter_max": 35.0, "leading_edge_width_min": 2.0, "peakiness_max": 7.0, "ice_concentration_min": 3.0},
    }
}


def lrm_backscatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_extendedprice")
    level = radar.sigma0_lrm(F.col("l_quantity") * 1000 + 700000, (F.col("l_tax") + 0.001) * 1e-12, F.col("l_discount"), F.col("l_tax"), -0.5)
    delay = radar.first_bin_delay(F.col("l_extendedprice"), [F.col("l_tax"), F.col("l_discount")], 46.0, 0.4684)
    return rounded(li.select("l_orderkey", "l_linenumber", level.alias("sigma0"), delay.alias("first_bin")), 7)


def option_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("sigma0"), (F.col("l_tax") * 100).alias("peakiness"), (F.col("l_discount") * 100).alias("sic"),
        (F.col("l_quantity") / 5).alias("leading_edge_width"), F.month("l_shipdate").alias("month"),
    )
    rules = radar.threshold_rules(OPTIONS)
    out = classify(rules, F.lit(0), F.col("month"))
    other = radar.external_classes(F.col("l_linenumber"), F.col("sic"), {"ocean": {"nn": [1, 2], "sic": 5.0}, "lead": {"nn": [2, 4], "sic": 6.0}, "sea_ice": {"nn": [1, 5], "sic": 5.0}})
    return li.select("l_orderkey", "l_linenumber", out.cast("int").alias("by_thresholds"), other.cast("int").alias("by_codes"))


def chart_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.col("s_suppkey") % 4 * 10).cast("int").alias("CT"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(None)).otherwise(F.col("s_suppkey") % 5 * 10).cast("int").alias("CA"),
        (F.lit(80) + F.col("s_suppkey") % 9).cast("int").alias("SA"),
    )
    codes = {"concentration": {0: 0, 10: 1, 20: 2, 30: 3, 40: 4}, "stage": {81: 1, 82: 1, 83: 2, 84: 2, 85: 2, 86: 3, 87: 3}}
    return decode_chart_codes(s, codes, {"concentration": ["CT", "CA"], "stage": ["SA"]})


def auxiliary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concentration, type, seasonal density and risk along events of a day, each from its provider."""
    e = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("segment_id"), F.col("event_id").alias("record_idx"), F.col("ts").alias("time"), (F.col("event_id") % 360 - 180).cast("double").alias("longitude"),
        (F.lit(65.0) + F.pmod(F.col("event_id") * 7, F.lit(2400)) / 100.0).alias("latitude"), F.lit("2024-01-20").cast("date").alias("day"),
    )
    cells = spark.range(GRID.numx * GRID.numy).select((F.col("id") % GRID.numx).cast("int").alias("ix"), F.floor(F.col("id") / GRID.numx).cast("int").alias("iy"))
    sic = cells.select("ix", "iy", ((F.col("ix") * 7 + F.col("iy") * 3) % 130 - 10).cast("double").alias("sea_ice_concentration"))
    kind = cells.select("ix", "iy", ((F.col("ix") + F.col("iy")) % 5).alias("ice_type"), (F.col("ix") % 6).alias("confidence_level"))
    aux = Auxiliary([("sic", "nearest", {"grid": GRID}), ("sitype", "codes", {"grid": GRID}), ("snow", "seasonal_density", {}), ("region", "nearest", {"grid": GRID, "region": "areas"})])
    areas = cells.select("ix", "iy", (F.col("ix") % 4).cast("int").alias("region_code")).filter("iy > 4")
    out = aux.apply(e, {"sic": sic, "sitype": kind, "areas": areas})
    mask = snow_validity_mask((F.col("region_code") > 1).cast("int"), F.col("latitude"))
    return rounded(out.select("record_idx", "sea_ice_concentration", "sea_ice_type", "sea_ice_type_uncertainty", "snow_density", "region_code", mask.cast("int").alias("snow_valid")))


QUERIES = {f.__name__: f for f in (lrm_backscatter, option_rules, chart_codes, auxiliary_chain)}

_E = "0.08181919084262157::double"
_Q = lambda s: f"((1 - {_E} * {_E}) * ({s} / (1 - {_E} * {s} * {_E} * {s}) + (1 / (2 * {_E})) * (ln((1 + {_E} * {s}) / (1 - {_E} * {s})))))"

SQL = {
    "lrm_backscatter": """
        with k as (
            select *, l_quantity * 1000 + 700000 as rng, (l_tax + 0.001::double) * 1e-12::double as p, sqrt(radians(l_discount) ** 2 + radians(l_tax) ** 2) as off,
                   2 / ln(2) * sin(1 / (1 / radians(1.06::double) + 1 / radians(1.1992::double))) ** 2 as gamma,
                   10 * log10(299792458.0::double * pi() * 0.022084::double ** 2 * 18197.008586099826::double ** 2 * 4.183e-9::double / ((4 * pi() * 720000.0::double) ** 3 * ((720000.0::double + 6378137.0::double) / 6378137.0::double))) as c
            from lineitem
        )
        select l_orderkey, l_linenumber, round(10 * log10(p / 22.4::double) - c + 30 * log10(rng / 720000.0::double) - 10 * (-4 * sin(off) ** 2 / gamma) / ln(10) - 0.5, 7) + 0.0 as sigma0,
               round(l_extendedprice - 46.0::double * 0.4684::double + l_tax + l_discount, 7) + 0.0 as first_bin from k
    """,
    "option_rules": """
        with v as (select l_orderkey, l_linenumber, l_quantity as s0, l_tax * 100 as pp, l_discount * 100 as sic, l_quantity / 5 as lew, month(l_shipdate) as m from lineitem)
        select l_orderkey, l_linenumber,
               case when s0 >= 2 and s0 <= 35 and lew >= 2 and pp <= 7 and sic > 3 then 4 when s0 >= 20 and lew <= 6 and pp >= 2.0 + 0.5 * (m - 1) and sic > 4 then 2 when pp <= 3 and sic < 5 then 1 else 0 end as by_thresholds,
               case when l_linenumber in (1, 5) and sic >= 5 then 4 when l_linenumber in (2, 4) and sic >= 6 then 2 when l_linenumber in (1, 2) and sic < 5 then 1 else 0 end as by_codes from v
    """,
    "chart_codes": """
        with s as (select s_suppkey, cast(s_suppkey % 4 as integer) as ct, case when s_suppkey % 3 <> 0 then cast(s_suppkey % 5 as integer) else -9 end as ca, cast(80 + s_suppkey % 9 as integer) as sa from supplier)
        select s_suppkey, ct as CT, case when ca = -9 and ct > 0 then ct else ca end as CA,
               cast(case when sa in (81, 82) then 1 when sa in (83, 84, 85) then 2 when sa in (86, 87) then 3 else sa end as integer) as SA from s
    """,
    "auxiliary_chain": f"""
        with p as (select event_id, event_id % 360 - 180 as lon, 65.0 + (event_id * 7 % 2400) / 100.0 as lat from events),
        r as (select *, 6378137.0 * sqrt(greatest({_Q('1.0')} - {_Q('sin(radians(lat))')}, 0)) as rho from p),
        x as (select event_id, lat, cast(floor((rho * sin(radians(lon)) + 4000000.0) / 400000.0 - 0.5 + 0.5) as integer) as ix, cast(floor((-rho * cos(radians(lon)) + 4000000.0) / 400000.0 - 0.5 + 0.5) as integer) as iy from r),
        c as (select *, ix between 0 and 19 and iy between 0 and 19 as inside, (ix * 7 + iy * 3) % 130 - 10 as sic from x),
        d as (select *, case when inside and iy > 4 then ix % 4 else -1 end as region from c)
        select event_id as record_idx, case when not inside then null when sic between 0 and 100 then cast(sic as double) else 0.0 end as sea_ice_concentration,
               case when inside then case (ix + iy) % 5 when 2 then 0.0 when 3 then 1.0 when 4 then 0.5 end end::double as sea_ice_type,
               case when inside then case ix % 6 when 0 then 1.0 when 1 then 1.0 when 2 then 0.5 when 3 then 0.2 when 4 then 0.1 else 0.0 end end::double as sea_ice_type_uncertainty,
               case when inside then round(6.5::double * (97 / 182.0::double * 6.0::double) + 274.51::double, 6) end as snow_density, cast(region as integer) as region_code,
               case when lat <= 65 then 0 when lat >= 89 then 1 when region > 1 then 1 else 0 end as snow_valid from d
    """,
}
