"""Record-wise operators: classification, filters, flags and physics over orders, order lines and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions import geodesy as Y
from firnline.functions import physics as P
from firnline.functions.predicates import classify
from firnline.functions.vocab import ERROR_BITS, raise_bit
from firnline.operators import filters as R
from firnline.operators.lookups import code_value
from firnline.plans.steps import Pipeline
from firnline.plans.tables import EVENTS, SURFACE_SQL, events, load, rounded, surface_of_line
from firnline.sources.manifest import newest_versions, overlapping, parse_names
from firnline.sources.records import tai_to_utc, union_products

MONTHLY = [100000.0 + 5000.0 * m for m in range(12)]
RULES = [
    {"surface_type": "ocean", "conditions": ["{price} <= 60000.0"], "radar_mode": 0},
    {"surface_type": "lead", "conditions": ["{price} >= " + str(MONTHLY).replace("'", ""), "{size} > 2"], "radar_mode": 0},
    {"surface_type": "sea_ice", "conditions": ["{price} >= 60000.0", "{price} < " + str(MONTHLY)]},
    {"surface_type": "polynya", "conditions": {"price": "{} < 20000.0"}, "exclude": "ocean"},
]


def _orders(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 2).cast("int").alias("radar_mode"),
        F.month("o_orderdate").alias("month"), (F.col("o_custkey") % 7).alias("size"), (F.col("o_orderpriority") == "5-LOW").alias("land"),
    )


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(RULES, F.col("radar_mode"), F.col("month"), land=F.col("land") & (F.col("size") == 0))
    return _orders(spark, sf_dir).select("o_orderkey", out.cast("int").alias("surface_type"))


def _lines(spark, sf_dir, *columns: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)


def valid_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_discount", "l_extendedprice", "l_tax").withColumnsRenamed({"l_extendedprice": "price", "l_tax": "price_uncertainty"})
    return rounded(R.valid_range(li, "l_discount", 0.02, 0.08, ["price"], "outside"))


def bit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.lit(0)
    for bit, condition in (
        ("filter", F.col("l_discount") > 0.05), ("thickness", F.col("l_tax") < 0.02), ("filter", F.col("l_quantity") > 40), ("other", F.col("l_returnflag") == "R"),
    ):
        flag = raise_bit(flag, ERROR_BITS[bit], condition)
    li = _lines(spark, sf_dir, "l_discount", "l_tax", "l_quantity", "l_returnflag")
    return li.select("l_orderkey", "l_linenumber", flag.alias("flag"))


def surface_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_returnflag", "l_linestatus", "l_quantity", "l_tax")
    li = li.withColumn("surface", surface_of_line(F.col("l_returnflag"), F.col("l_linestatus"))).withColumnsRenamed({"l_quantity": "q", "l_tax": "q_uncertainty"})
    return rounded(R.remove_surface_types(li, "surface", ["lead", "ocean"], ["q"]).select("l_orderkey", "l_linenumber", "q", "q_uncertainty"))


def orbit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "value").withColumn("latitude", F.col("value") - 50)
    return rounded(R.orbit_direction(df, EVENTS, "latitude", "ascending", ["value"]).select("event_id", "value"))


def prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_discount", "l_quantity", "l_tax").withColumn("sit", F.when(F.col("l_discount") > 0.03, F.col("l_discount")))
    return rounded(R.transfer_nulls(li, "sit", ["l_quantity", "l_tax"]).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"))


def miz_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    wave = R.wave_zone_flag(c("l_quantity") * 10, c("l_tax") * 100, c("l_discount") * 1000, 200.0, 4.0)
    near = R.proximity_flag(c("l_quantity") * 10, c("l_discount") * 1000, c("l_tax") * 10, c("l_extendedprice") / 1000, 300.0, 60.0, 0.3, 40.0)
    li = _lines(spark, sf_dir, "l_quantity", "l_tax", "l_discount", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", wave.cast("int").alias("wave"), near.cast("int").alias("near"))


def edge_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.edge_transitions(events(spark, sf_dir, "value"), EVENTS, "value", 50.0).select("event_id", "is_ice_edge")


def sparse_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir, "event_type", "value").withColumns({
        "surface": F.when(F.col("event_type") == "click", 7).otherwise(1), "tie": F.col("event_type") == "purchase",
    })
    return rounded(R.sparse_sections(df, EVENTS, "surface", "tie", 1, ["value"]).select("event_id", "value"))


def thickness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, rho_w = F.col, F.lit(1024.0)
    li = _lines(spark, sf_dir, "l_discount", "l_tax", "l_quantity", "l_extendedprice")
    frb, sd, rho_i, rho_s = c("l_discount") * 5, c("l_tax") * 5, F.lit(880.0) + c("l_quantity"), F.lit(280.0) + c("l_quantity")
    sit = P.ice_freeboard_to_thickness(frb, sd, rho_w, rho_i, rho_s)
    unc = P.thickness_uncertainty(frb, sd, rho_w, rho_i, rho_s, F.lit(0.1), F.lit(0.05), F.lit(23.0), F.lit(50.0))
    return rounded(li.select(
        "l_orderkey", "l_linenumber", sit.alias("sit"), unc.alias("sit_unc"), P.draft(sit, frb).alias("draft"),
        P.snow_freeboard_to_thickness(frb, sd, rho_w, rho_i, rho_s).alias("sit_snow"), (P.snow_speed_factor(rho_s) * sd).alias("snow_correction"),
    ))


def scalar_physics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    li = _lines(spark, sf_dir, "l_discount", "l_tax", "l_quantity", "l_shipdate")
    dot, dot_unc = P.dynamic_topography(c("l_discount"), c("l_tax"), c("l_tax"), c("l_discount"))
    day = F.to_date("l_shipdate")
    return rounded(li.select(
        "l_orderkey", "l_linenumber", P.peakiness_range_correction(c("l_discount") * 5).alias("pp_correction"), P.ice_density(c("l_discount") * 10).alias("rho_i"),
        dot.alias("dot"), dot_unc.alias("dot_unc"), P.seasonal_snow_density(day, P.winter_start(day)).alias("snow_density"),
        P.sea_level_uncertainty(c("l_quantity"), 0.02, 0.1, 30.0).alias("sla_unc"), P.pulse_deblurring((c("l_discount") - 0.05) * 1e-7).alias("deblurring"),
        P.drift_correction(c("l_tax"), c("l_shipdate"), 1995, 6, -0.002).alias("drift"), P.footprint_pulse_limited(c("l_quantity") * 20000, 3.2e8).alias("footprint"),
        P.sigma0_pulse_limited(c("l_tax") + 0.01, F.lit(2.0), c("l_quantity") * 20000, wavelength=0.022084, gain=19054.6).alias("sigma0"),
    ), 5)


def snow_climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir, "l_quantity", "l_tax", "l_discount", "l_shipdate")
    w = P.snow_climatology(F.col("l_quantity") / 10 - 2, F.col("l_tax") * 20, F.month("l_shipdate"))
    depth, unc = P.scale_first_year_snow(w["snow_depth"], w["snow_depth_uncertainty"], F.col("l_discount") * 10, F.lit(0.1), 0.5)
    return rounded(li.select("l_orderkey", "l_linenumber", w["snow_depth"].alias("depth"), F.round(w["snow_density"], 6).alias("density"), depth.alias("scaled"), unc.alias("scaled_unc")), 14)


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 360).cast("double").alias("lon"), (F.lit(-80.0) + F.col("c_custkey") % 50).alias("lat"))
    return c.select("c_custkey", Y.antarctic_sea(F.col("lon"), F.col("lat")).alias("region"), Y.angular_distance(F.col("lon"), F.lit(350.0)).alias("away"), Y.wrap_longitude(F.col("lon")).alias("wrapped"))


def code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier").select("s_suppkey", code_value(F.col("s_suppkey") % 6, [None, None, 0.0, 1.0, 0.5]).alias("sea_ice_type"))
    return s


def product_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return union_products([c, s]).filter(F.col("balance").isNotNull() & (F.col("balance") > 0))


def name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    name = F.concat(F.lit("/data/"), F.lower("o_orderstatus"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_v"), F.lpad((F.col("o_custkey") % 100).cast("string"), 3, "0"), F.lit(".nc"))
    out = parse_names(o.withColumn("path", name), F.col("path"), "{mission}_{start:timestamp}_v{version:int}.nc")
    return out.select("o_orderkey", "mission", "start", "version")


def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("start_key"), F.col("o_orderdate").alias("created"), F.col("o_orderkey").cast("string").alias("path"))
    out = newest_versions(o, ["start_key"], "created")
    return out.select("o_orderkey", "start_key", "created")


def overlapping_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    spans = o.select("o_orderkey", F.col("o_orderdate").alias("tcs"), (F.col("o_orderdate") + F.expr("interval 10 days")).alias("tce"))
    import datetime

    return overlapping(spans, "tcs", "tce", datetime.datetime(1995, 3, 1), datetime.datetime(1995, 3, 31))


def leap_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", tai_to_utc(F.col("o_orderdate")).alias("utc"))


def record_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared pipeline from elevations to thickness over order lines."""
    li = _lines(spark, sf_dir, "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity")
    df = li.withColumns({
        "segment_id": F.col("l_orderkey"), "record_idx": F.col("l_linenumber"), "surface_type": surface_of_line(F.col("l_returnflag"), F.col("l_linestatus")),
        "elevation": F.col("l_quantity") / 20, "elevation_uncertainty": F.lit(0.1), "mean_sea_surface": F.col("l_tax"), "sea_level_anomaly": F.col("l_discount") / 10,
        "sea_level_anomaly_uncertainty": F.lit(0.05), "snow_depth": F.col("l_tax") * 4, "snow_depth_uncertainty": F.lit(0.02), "snow_density": F.lit(320.0),
        "snow_density_uncertainty": F.lit(30.0), "sea_ice_type": F.col("l_discount") * 10,
    })
    steps = [
        {"step": "radar_freeboard"}, {"step": "snow_correction", "options": {"factor": 0.22}},
        {"step": "valid_range", "options": {"source": "radar_freeboard", "min": -0.25, "max": 2.25, "targets": ["radar_freeboard", "sea_ice_freeboard"]}},
        {"step": "ice_density"}, {"step": "thickness"},
        {"step": "valid_range", "options": {"source": "sea_ice_thickness", "min": -0.5, "max": 10.5, "targets": ["sea_ice_thickness"]}}, {"step": "draft"},
    ]
    out = Pipeline.from_config({"procsteps": steps}).apply(df)
    return rounded(out.select("l_orderkey", "l_linenumber", "sea_ice_freeboard", "sea_ice_thickness", "sea_ice_thickness_uncertainty", "sea_ice_draft", "flag"), 5)


def correction_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevations of given ranges with peakiness, deblurring and sea-state corrections, and the sea surface height."""
    li = _lines(spark, sf_dir, "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity")
    df = li.withColumns({
        "segment_id": F.col("l_orderkey"), "record_idx": F.col("l_linenumber"), "surface_type": surface_of_line(F.col("l_returnflag"), F.col("l_linestatus")),
        "altitude": F.lit(800.0), "range_a": F.col("l_quantity") * 2, "range_b": F.col("l_quantity") * 3, "peakiness": F.col("l_discount") * 4,
        "epss": (F.col("l_tax") - 0.04) * 1e-7, "wave_height": F.col("l_tax") * 40, "wind_speed": F.col("l_discount") * 30, "mean_sea_surface": F.lit(2.0),
    })
    steps = [
        {"step": "elevations", "options": {"names": ["a", "b"], "use": "b"}}, {"step": "peakiness_correction"}, {"step": "pulse_deblurring"},
        {"step": "sea_state_bias", "options": {"table": [[0.0, 0.1, 0.2], [0.1, 0.3, 0.5], [0.2, 0.4, 0.7]], "wave_step": 2.0, "wind_step": 2.0}},
        {"step": "raw_sea_level"}, {"step": "sea_surface_height"}, {"step": "remove_non_ocean", "options": {"targets": ["elevation"]}},
    ]
    out = Pipeline.from_config({"procsteps": steps}).apply(df)
    return rounded(out.select("l_orderkey", "l_linenumber", "elevation_a", "elevation", "sea_state_bias", "sea_surface_height", "flag"), 7)


QUERIES = {
    f.__name__: f
    for f in (
        classification, valid_range, bit_flags, surface_filter, orbit_filter, prefilter, miz_flags, edge_transitions, sparse_sections, thickness, scalar_physics,
        snow_climatology, region_codes, code_lookup, product_union, name_fields, newest_files, overlapping_files, leap_seconds, record_pipeline, correction_pipeline,
    )
}

_ORDER = "partition by user_id order by ts, event_id"
_MONTH = f"list_extract({MONTHLY}, month)"
_LIST = lambda table, k: "list_extract([" + ", ".join(str(row[k]) for row in table) + "], month(l_shipdate))"
_FIT = lambda t: "(" + " + ".join(f"{_LIST(t, k)}::double * {m}" for k, m in enumerate(("1", "x", "y", "x * y", "x * x", "y * y"))) + ") * 0.01"
_ARC = lambda low, high: f"((lon - {low}) % 360 + 360) % 360 <= {(high - low) % 360}"

SQL = {
    "classification": f"""
        with o as (select o_orderkey, o_totalprice as price, o_orderkey % 2 as mode, month(o_orderdate) as month, o_custkey % 7 as size, o_orderpriority = '5-LOW' as land from orders),
        a as (select *, case when price <= 60000 and mode = 0 then 1 else 0 end as s1 from o),
        b as (select *, case when price >= {_MONTH} and size > 2 and mode = 0 then 2 else s1 end as s2 from a),
        c as (select *, case when price >= 60000 and price < {_MONTH} then 4 else s2 end as s3 from b),
        d as (select *, case when price < 20000 and s3 <> 1 then 3 else s3 end as s4 from c)
        select o_orderkey, cast(case when land and size = 0 then 7 else s4 end as integer) as surface_type from d
    """,
    "valid_range": """
        select l_orderkey, l_linenumber, round(l_discount, 6) + 0.0 as l_discount, round(case when l_discount < 0.02 or l_discount > 0.08 then null else l_extendedprice end, 6) + 0.0 as price,
               round(case when l_discount < 0.02 or l_discount > 0.08 then null else l_tax end, 6) + 0.0 as price_uncertainty, l_discount < 0.02 or l_discount > 0.08 as outside from lineitem
    """,
    "bit_flags": """
        select l_orderkey, l_linenumber, (case when l_discount > 0.05 or l_quantity > 40 then 512 else 0 end) | (case when l_tax < 0.02 then 256 else 0 end)
               | (case when l_returnflag = 'R' then 32768 else 0 end) as flag from lineitem
    """,
    "surface_filter": f"""
        with l as (select *, {SURFACE_SQL} as s from lineitem)
        select l_orderkey, l_linenumber, round(case when s in (1, 2) then null else l_quantity end, 6) + 0.0 as q, round(case when s in (1, 2) then null else l_tax end, 6) + 0.0 as q_uncertainty from l
    """,
    "orbit_filter": f"""
        select event_id, round(case when coalesce(lead(value - 50) over ({_ORDER}) - (value - 50) < 0, false) then null else value end, 6) + 0.0 as value from events
    """,
    "prefilter": """
        select l_orderkey, l_linenumber, round(case when l_discount > 0.03 then l_quantity end, 6) + 0.0 as l_quantity, round(case when l_discount > 0.03 then l_tax end, 6) + 0.0 as l_tax from lineitem
    """,
    "miz_flags": """
        select l_orderkey, l_linenumber, case when l_quantity * 10 <= 200 and l_tax * 100 >= 4 and l_discount * 1000 >= 15 then 1 else 0 end as wave,
               case when l_quantity * 10 <= 300 and l_discount * 1000 <= 60 and l_tax * 10 >= 0.3 and l_extendedprice / 1000 <= 40 then 2 when l_quantity * 10 <= 300 then 1 else 0 end as near from lineitem
    """,
    "edge_transitions": f"""
        select event_id, coalesce((value > 50) <> (lag(value) over ({_ORDER}) > 50) and lead(value) over ({_ORDER}) is not null, false) as is_ice_edge from events
    """,
    "sparse_sections": f"""
        with p as (select *, event_type = 'click' as land, case when row_number() over ({_ORDER}) = 1 or lag(event_type = 'click') over ({_ORDER}) = (event_type = 'click') then 0 else 1 end as c from events),
        i as (select *, sum(c) over ({_ORDER} rows unbounded preceding) as part from p),
        t as (select *, count(*) filter (event_type = 'purchase') over (partition by user_id, part) as ties from i)
        select event_id, round(case when not land and ties < 1 then null else value end, 6) + 0.0 as value from t
    """,
    "thickness": """
        with v as (select l_orderkey, l_linenumber, l_discount * 5 as f, l_tax * 5 as sd, 880.0 + l_quantity as ri, 280.0 + l_quantity as rs, 1024.0 as rw from lineitem),
        s as (select *, (rw * f + rs * sd) / (rw - ri) as sit from v)
        select l_orderkey, l_linenumber, round(sit, 6) + 0.0 as sit,
               round(sqrt((rw / (rw - ri) * 0.1) ** 2 + ((f * rw + sd * rs) / ((rw - ri) * (rw - ri)) * 23.0) ** 2 + (rs / (rw - ri) * 0.05) ** 2 + (sd / (rw - ri) * 50.0) ** 2), 6) + 0.0 as sit_unc,
               round(sit - f, 6) + 0.0 as draft, round((rw * f + (rs - rw) * sd) / (rw - ri), 6) + 0.0 as sit_snow,
               round((pow(1.0 + 0.51 * rs / 1000.0, 1.5) - 1.0) * sd, 6) + 0.0 as snow_correction from s
    """,
    "scalar_physics": """
        with v as (select *, l_discount * 5 as pp, cast(l_shipdate as date) as d, make_date(year(l_shipdate) - case when month(l_shipdate) >= 10 then 0 else 1 end, 10, 15) as w, l_quantity * 20000 as r from lineitem),
        k as (select *, ((-1390.0 * 0.1 + 339.0) * 0.1 - 28.4) * 0.1 + 0.994 as knee, pi() * (r * 299792458.0 / 320000000.0) / 1e6 as area from v)
        select l_orderkey, l_linenumber, round(case when pp > 0.33 then 0.25 when pp > 0.1 then (pp - 0.1) * (0.25 - knee) / 0.23 + knee else ((-1390.0 * pp + 339.0) * pp - 28.4) * pp + 0.994 end, 5) + 0.0 as pp_correction,
               round(916.7 - l_discount * 10 * (916.7 - 882.0), 5) + 0.0 as rho_i, round(l_discount + l_tax, 5) + 0.0 as dot, round(sqrt(l_discount * l_discount / 3 + l_tax * l_tax), 5) + 0.0 as dot_unc,
               round(6.5 * (date_diff('day', w, d) / 182.0 * 6.0) + 274.51, 5) + 0.0 as snow_density, round(0.02 + 0.08 * pow(least(l_quantity / 30.0, 1.0), 2), 5) + 0.0 as sla_unc,
               round(case when (l_discount - 0.05) * 1e-7 * 0.5 * 299792458.0 < 0 then (l_discount - 0.05) * 1e-7 * 0.5 * 299792458.0 / 5.0 else 0.0 end, 5) + 0.0 as deblurring,
               round(l_tax - 0.002 * ((1995 - year(l_shipdate)) * 12 + (6 - month(l_shipdate))), 5) + 0.0 as drift, round(area, 5) + 0.0 as footprint,
               round(10 * log10((l_tax + 0.01) / 2.0) + 10 * log10(pow(4 * pi(), 3) / (0.022084::double * 0.022084::double * 19054.6::double * 19054.6::double) * pow(r, 4) / area), 5) + 0.0 as sigma0 from k
    """,
    "snow_climatology": f"""
        with v as (select *, l_quantity / 10 - 2 as x, l_tax * 20 as y from lineitem),
        s as (select *, {_FIT(P.W99_SNOW_DEPTH)} as sd, {_FIT(P.W99_WATER_EQUIVALENT)} as swe, ({_LIST(P.W99_SNOW_DEPTH, 6)} + {_LIST(P.W99_SNOW_DEPTH, 9)}) * 0.01 as u from v),
        f as (select *, (1 - l_discount * 10) * 0.5 as f from s)
        select l_orderkey, l_linenumber, round(sd, 14) + 0.0 as depth, round(swe / sd * 1024.0, 6) + 0.0 as density, round(sd - f * sd, 14) + 0.0 as scaled,
               round(u - f * u + (sd - f * sd) * f * 0.1, 14) + 0.0 as scaled_unc from f
    """,
    "region_codes": f"""
        with p as (select c_custkey, cast(c_custkey % 360 as double) as lon, -80.0 + c_custkey % 50 as lat from customer)
        select c_custkey, case when lat >= -50 then 0 {" ".join(f"when {_ARC(low, high)} then {code}" for code, (_, low, high) in reversed(list(enumerate(Y.ANTARCTIC_SEAS, 2))))} else 0 end as region,
               least(abs(lon - 350) % 360, 360 - abs(lon - 350) % 360) as away, (lon + 180) % 360 - 180 as wrapped from p
    """,
    "code_lookup": "select s_suppkey, case s_suppkey % 6 when 2 then 0.0 when 3 then 1.0 when 4 then 0.5 end::double as sea_ice_type from supplier",
    "product_union": """
        select c_custkey as key, c_acctbal as balance, c_mktsegment as segment from customer where c_acctbal > 0
        union all select s_suppkey, s_acctbal, null from supplier where s_acctbal > 0
    """,
    "name_fields": "select o_orderkey, lower(o_orderstatus) as mission, date_trunc('second', o_orderdate) as start, cast(o_custkey % 100 as integer) as version from orders",
    "newest_files": """
        select o_orderkey, o_custkey as start_key, o_orderdate as created from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc nulls last, cast(o_orderkey as varchar)) = 1
    """,
    "overlapping_files": """
        select o_orderkey, o_orderdate as tcs, o_orderdate + interval 10 days as tce from orders where o_orderdate <= timestamp '1995-03-31' and o_orderdate + interval 10 days >= timestamp '1995-03-01'
    """,
    "leap_seconds": """
        select o_orderkey, o_orderdate - to_seconds(case when o_orderdate >= timestamp '1999-01-01 00:00:32' then 32 when o_orderdate >= timestamp '1997-07-01 00:00:31' then 31
               when o_orderdate >= timestamp '1996-01-01 00:00:30' then 30 when o_orderdate >= timestamp '1994-07-01 00:00:29' then 29 when o_orderdate >= timestamp '1993-07-01 00:00:28' then 28
               when o_orderdate >= timestamp '1992-07-01 00:00:27' then 27 when o_orderdate >= timestamp '1991-01-01 00:00:26' then 26 else 25 end) as utc from orders
    """,
    "record_pipeline": f"""
        with v as (select *, {SURFACE_SQL} as s, l_quantity / 20 - l_tax - l_discount / 10 as rf0, sqrt(0.1 * 0.1 + 0.05 * 0.05) as urf, l_tax * 4 as sd, 916.7 - l_discount * 10 * (916.7 - 882.0) as ri, 35.7 - l_discount * 10 * 12.7 as uri from lineitem),
        a as (select *, s = 4 and (rf0 < -0.25 or rf0 > 2.25) as out1 from v),
        b as (select *, case when s = 4 and not out1 then rf0 + 0.22 * sd end as f, case when s = 4 and not out1 then sqrt((0.22 * 0.02) ** 2 + urf ** 2) end as uf from a),
        c as (select *, (1024.0 * f + 320.0 * sd) / (1024.0 - ri) as t0,
                     sqrt((1024.0 / (1024.0 - ri) * uf) ** 2 + ((f * 1024.0 + sd * 320.0) / ((1024.0 - ri) * (1024.0 - ri)) * uri) ** 2 + (320.0 / (1024.0 - ri) * 0.02) ** 2 + (sd / (1024.0 - ri) * 30.0) ** 2) as ut0 from b),
        d as (select *, coalesce(t0 < -0.5 or t0 > 10.5, false) as out2 from c)
        select l_orderkey, l_linenumber, round(f, 5) + 0.0 as sea_ice_freeboard, round(case when not out2 then t0 end, 5) + 0.0 as sea_ice_thickness,
               round(case when not out2 then ut0 end, 5) + 0.0 as sea_ice_thickness_uncertainty, round(case when not out2 then t0 - f end, 5) + 0.0 as sea_ice_draft,
               (case when out1 or out2 then 512 else 0 end) | (case when t0 is null then 256 else 0 end) as flag from d
    """,
    "correction_pipeline": f"""
        with v as (
            select *, {SURFACE_SQL} as s, l_discount * 4 as pp, ((-1390.0::double * 0.1::double + 339) * 0.1::double - 28.4::double) * 0.1::double + 0.994::double as knee, (l_tax - 0.04::double) * 1e-7::double * 0.5::double * 299792458.0::double as eps,
                   l_tax * 40 / 2 as x, l_discount * 30 / 2 as y, [[0.0, 0.1, 0.2], [0.1, 0.3, 0.5], [0.2, 0.4, 0.7]]::double[][] as t from lineitem
        ), w as (
            select *, cast(floor(x) as integer) as i, cast(floor(y) as integer) as j, x - floor(x) as px, y - floor(y) as py from v
        ), b as (
            select *, t[i + 1][j + 1] as c00, coalesce(t[i + 1][j + 2], t[i + 1][j + 1]) as c01, coalesce(t[i + 2][j + 1], t[i + 1][j + 1]) as c10, coalesce(t[i + 2][j + 2], t[i + 1][j + 2], t[i + 2][j + 1], t[i + 1][j + 1]) as c11 from w
        ), z as (
            select *, case when s in (1, 2) then coalesce((c00 * (1 - py) + c01 * py) * (1 - px) + (c10 * (1 - py) + c11 * py) * px, 0.0) else 0.0 end as ssb,
                   800.0 - l_quantity * 3 - case when pp > 0.33 then 0.25 when pp > 0.1 then (pp - 0.1::double) * (0.25::double - knee) / 0.23::double + knee else ((-1390.0::double * pp + 339) * pp - 28.4::double) * pp + 0.994::double end
                   + case when eps < 0 then eps / 5 else 0.0 end as e0 from b
        )
        select l_orderkey, l_linenumber, round(800.0 - l_quantity * 2, 7) + 0.0 as elevation_a, round(e0 - ssb, 7) + 0.0 as elevation, round(ssb, 7) + 0.0 as sea_state_bias,
               round(case when s = 2 then 2.0 + (e0 - ssb - 2.0) end, 7) + 0.0 as sea_surface_height, case when s = 2 then 0 else 64 end as flag from z
    """,
}
