"""Instrument geometry, waveform scaling, thresholds, level-1 processors, filters and masks over the input tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions import geodesy as Y
from firnline.functions import physics as P
from firnline.functions import radar
from firnline.functions import vocab
from firnline.functions import waveform as V
from firnline.operators import filters as R
from firnline.operators import grid as G
from firnline.operators import retrack as T
from firnline.operators import windows as N
from firnline.operators.auxiliary import Auxiliary
from firnline.operators.sealevel import SeaLevel, footprint_spacing, smoothed_linear
from firnline.plans.level1 import preprocess, processor
from firnline.plans.steps import Pipeline
from firnline.plans.tables import EVENTS, SURFACE_SQL, events, load, rounded, surface_of_line
from firnline.sources import adapters
from firnline.sources.manifest import day_files, detect_version, period_files, polar_ocean_files, xml_fields
from firnline.sources.records import daily_merge
from firnline.streaming.sessions import chains, grid_counts


def _lines(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_extendedprice", surface_of_line(F.col("l_returnflag"), F.col("l_linestatus")).alias("surface_type"))


def _echoes(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("w"))


def radar_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, t, d, x = (F.col(c) for c in ("l_quantity", "l_tax", "l_discount", "l_extendedprice"))
    r, v = q * 1000 + 700000, t * 100 + 7000
    area = P.footprint_sar(r, v, 2.8e-9, 0.001, 0.022, 1.5)
    cycle, track = P.sub_cycle(F.floor(x).cast("long"))
    return rounded(_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", (area / 1e6).alias("footprint"), P.sigma0((d + 0.01) * 1e-12, q, r, area, 0.022, 18197.0, 2.0, 0.5).alias("sigma0"),
        cycle.alias("sub_cycle"), track.alias("rel_track"), P.velocity(q, t, d).alias("velocity"), Y.mispointing(d * 10, t * 10, q).alias("mispointing"),
        Y.ellipsoid_delta(q, 6378136.3, 1 / 298.257, 6378137.0, 1 / 298.257223563).alias("delta_h"), radar.first_bin_delay(x, [t * -3.0], 63.0, 0.47).alias("window_delay"),
        V.width_to_nu(q, 2.0, 0.5, 0.1, 2.1).alias("nu"), V.epoch_to_range(t * 1e-6, F.array(x, q), 0).alias("epoch_range"), V.inverse_power(q, x, t, d).alias("decay"),
    ), 5)


def echo_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts to power, ranges from a tracker, side peakiness, noise removal, misfit and determination against the echo
    read backwards, resampling by mode."""
    w, back = F.col("w"), F.reverse("w")
    mode = (F.col("vec_id") % 3).cast("int")
    df = _echoes(spark, sf_dir).withColumns({"r": V.correct_ranges(V.tracker_ranges(F.col("vec_id") / 7, 44.5, 0.47, 64), F.when(F.col("vec_id") % 2 == 0, F.lit(0.25)))})
    short = radar.resample_by_mode(mode, w, 40, 72)
    angles = V.look_angles(F.col("vec_id") / 1000, F.col("vec_id") / 1000 + 1, 5)
    return rounded(df.select(
        "vec_id", V.total(V.scaled_power(w, F.lit(2.5), F.lit(3.0))).alias("watts"), F.get("r", F.lit(0)).alias("first_range"), F.element_at("r", -1).alias("last_range"),
        V.side_peakiness(w, 1, "left").alias("left_peakiness"), V.side_peakiness(w, 1, "right").alias("right_peakiness"), V.total(V.without_noise(w, 11)).alias("clean"),
        V.misfit(w, back, V.peak(w)).alias("misfit"), V.determination(w, back).alias("r2"), F.size(short).alias("bins"), V.total(short).alias("resampled"),
        F.get(angles, F.lit(3)).alias("angle"), V.late_tail_ratio(w, 10, 20).alias("late_tail"),
    ), 7)


def echo_backscatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backscatter by radar mode: peak and SAR footprint, or OCOG amplitude and pulse-limited footprint."""
    options = {"wavelength": 0.022, "gain": 18197.0, "bandwidth": 3.2e8, "ptr_width": 2.8e-9, "burst": 0.001, "bias": {"lrm": 0.1, "sar": 0.2, "sin": -0.3}}
    mode, sent, r, v = (F.col("vec_id") % 4).cast("int"), F.lit(20.0) + F.col("vec_id") % 3, F.lit(720000.0) + F.col("vec_id"), F.lit(7500.0)
    return rounded(_echoes(spark, sf_dir).select("vec_id", radar.sigma0_by_mode(mode, F.col("w"), sent, r, v, options).alias("sigma0"), radar.by_mode(mode, {"lrm": F.lit(1), "sin": F.lit(3)}).alias("kind")))


def echo_ice_retracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("w")
    got = V.ocog_ice_retrack(w, V.window_ranges(F.lit(0.0048), 64), 0.6, 0.3, 2)
    valid = V.ocog_ice_valid(got, 4.0, 2.0, 1.5, 60.0)
    return rounded(_echoes(spark, sf_dir).select("vec_id", *[c.alias(k) for k, c in got.items()], valid.alias("valid")))


def retracker_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines(spark, sf_dir).withColumnsRenamed({"l_quantity": "sigma0", "l_discount": "sea_ice_type", "l_tax": "leading_edge_width", "l_extendedprice": "other"})
    li = li.withColumn("sea_ice_type", F.col("sea_ice_type") * 10)
    rules = {
        "plain": 0.4, "fixed": {"type": "fixed", "value": 0.5}, "by_sigma": {"type": "sigma_func", "coef": [0.1, 0.01, -0.0001]},
        "by_type": {"type": "sitype_sigma_func", "coef_fyi": [0.2, 0.01], "coef_myi": [0.3, -0.002]},
        "by_plane": {"type": "poly_plane_fit", "intercept": 0.3, "coef_lew": [0.5, -0.2], "coef_sig0": [0.01]}, "given": {"type": "l2_variable", "variable_name": "other"},
    }
    return rounded(li.select("l_orderkey", "l_linenumber", *[T.threshold_column(r).alias(k) for k, r in rules.items()]))


def retracked_surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two retrackers by surface type; lines of a low quantity cannot be retracked."""
    li = _lines(spark, sf_dir).withColumn("altitude", F.col("l_extendedprice"))

    def given(value):
        return F.when(F.col("l_quantity") > 5, F.struct(value.alias("range"), F.lit(1.0).alias("power"), F.col("l_tax").alias("uncertainty"), F.lit(3).alias("first_maximum_index"), F.lit(0.5).alias("leading_edge_width")))

    out = T.retrack_by_surface(li, {2: given(F.col("l_quantity")), 4: given(F.col("l_quantity") * 2)})
    return rounded(out.select("l_orderkey", "l_linenumber", "retracked_range", "elevation", "elevation_uncertainty", "retracker_failed", F.col("surface_type").cast("int").alias("surface_type")))


def record_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps that transfer, number modes, correct ranges, assume freeboards and smooth, with their error bits."""
    df = events(spark, sf_dir, "value").withColumns({
        "radar_mode": (F.col("event_id") % 3).cast("int"), "elevation": F.col("value"), "tide": F.when(F.col("event_id") % 5 > 0, F.col("event_id") % 7 / 10.0),
        "dry": F.col("event_id") % 11 / 10.0, "radar_freeboard": F.col("value") / 100, "radar_freeboard_uncertainty": F.lit(0.1),
    })
    steps = [
        ("transfer", {"columns": {"taken": "dry", "lost": "no_such"}}), ("instrument_mode", {}), ("range_corrections", {"corrections": ["tide", "dry"], "preserve_nan": True}),
        ("snow_freeboard_assumption", {}), ("smooth", {"source": "value", "target": "smooth", "method": "box_filter", "window": 3}),
    ]
    out = Pipeline(steps, EVENTS).apply(df)
    return rounded(out.select("event_id", "taken", "lost", "instrument_mode", "elevation", "total_range_correction", "sea_ice_freeboard", "sea_ice_freeboard_uncertainty", "smooth", "flag"))


def combined_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions accumulated by AND and OR, marginal-zone and tie-point filters along the events."""
    df = events(spark, sf_dir, "event_type", "value").withColumns({
        "flag_miz": (F.col("event_id") % 4).cast("int"), "sla": F.col("value"), "sla_uncertainty": F.col("value") / 10, "tie": F.col("event_type") == "purchase",
        "distance": F.col("event_id") % 9, "far": F.col("value"),
    })
    both = vocab.all_of(F.col("value") > 10, F.col("event_id") % 2 == 0, F.col("event_type") != "click")
    either = vocab.any_of(F.col("value") > 90, F.col("event_type") == "click")
    df = df.withColumns({"both": both, "either": either})
    df = R.marginal_ice_zone(df, 2, ["sla"])
    df = R.tie_point_distance_filter(df, EVENTS, "distance", 5, ["far"], "tie", edges_only=True)
    return rounded(df.select("event_id", "both", "either", "sla", "sla_uncertainty", "far"))


def reflected_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(N.uniform_reflect(events(spark, sf_dir, "value"), EVENTS, "value", 3, "smooth").select("event_id", "smooth"))


def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files (one per user) worth reading, and a field of each one's XML header."""
    e = events(spark, sf_dir, "value", "event_type")
    files = e.groupBy("user_id").agg(F.min(F.col("value") - 50).alias("lat_min"), F.max(F.col("value") - 50).alias("lat_max"), (F.avg((F.col("event_type") == "view").cast("double")) * 100).alias("open_ocean_percent"))
    header = F.concat(F.lit("<hdr><orbit>"), F.col("user_id").cast("string"), F.lit("</orbit><pct>"), F.round("open_ocean_percent", 3).cast("string"), F.lit("</pct></hdr>"))
    files = polar_ocean_files(files, 45.0, "north").withColumn("header", xml_fields(header, "orbit long, pct double"))
    return rounded(files.select("user_id", "lat_min", "lat_max", F.col("header.orbit").alias("orbit"), F.col("header.pct").alias("percent")))


def _files(spark, sf_dir) -> DataFrame:
    """A file for each user's events, named by its times, in a folder of its start's month."""
    spans = events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))
    half = F.when(F.col("user_id") % 2 == 0, F.lit("north")).otherwise(F.lit("south"))
    return spans.withColumn("path", F.concat(F.lit("/base/v1/"), half, F.lit("/"), F.date_format("start", "yyyy/MM"), F.lit("/f"), F.col("user_id").cast("string"), F.lit(".nc")))


def files_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir)
    out = period_files(files, "/base", "north", "2024-01-10", "2024-01-12", detect_version(files, "/base"))
    return out.select("user_id", "path")


def files_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_files(_files(spark, sf_dir), "2024-01-02").select("user_id")


def chosen_cell_uncertainties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two solutions of gridded uncertainties side by side, with ranges and other factors and names."""
    s = load(spark, sf_dir, "supplier")
    v = lambda k, d: (F.col("s_suppkey") % k + 1) / float(d)
    cells = s.select(
        "s_suppkey", v(7, 50).alias("radar_freeboard_l3_uncertainty"), F.when(F.col("s_suppkey") % 11 > 0, v(13, 20)).alias("sea_ice_freeboard"), v(5, 10).alias("snow_depth"), v(3, 30).alias("snow_depth_uncertainty"),
        (v(9, 1) * 10 + 250).alias("snow_density"), (v(4, 1) * 8).alias("snow_density_uncertainty"), (v(6, 1) * 5 + 880).alias("sea_ice_density"), (v(8, 1) * 4).alias("sea_ice_density_uncertainty"),
        F.when(F.col("s_suppkey") % 17 > 0, v(10, 2)).alias("sea_ice_thickness"), v(19, 90).alias("other_radar"),
    )
    everything = {"radar_freeboard": {"valid_range": (0.04, 0.1)}, "sea_ice_freeboard": {}, "sea_ice_thickness": {"valid_range": (0.5, 2.0)}, "sea_ice_draft": {}}
    out = G.chosen_uncertainties(cells, everything)
    other = {"radar_freeboard_l3_uncertainty": "other_radar", "sea_ice_freeboard_l3_uncertainty": "other_frb", "sea_ice_thickness_l3_uncertainty": "other_sit"}
    out = G.chosen_uncertainties(out, {"sea_ice_freeboard": {"snow_factor": 0.3}, "sea_ice_thickness": {"water_density": 1027.0}}, other)
    columns = [f"{k}_l3_uncertainty" for k in ("radar_freeboard", "sea_ice_freeboard", "sea_ice_thickness", "sea_ice_draft")]
    return rounded(out.select("s_suppkey", *columns, "other_frb", "other_sit"))


def masked_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks and ocean density joined to the cells of a grid."""
    li = load(spark, sf_dir, "lineitem")
    cells = li.groupBy((F.col("l_orderkey") % 25).cast("int").alias("yj"), (F.col("l_partkey") % 25).cast("int").alias("xi")).agg(F.count("*").alias("n"))
    some = cells.filter((F.col("yj") + F.col("xi")) % 3 > 0).select("yj", "xi", (F.col("yj") * 2).alias("value"))
    ocean = cells.filter(F.col("xi") % 4 > 0).select("yj", "xi", F.when((F.col("yj") * F.col("xi")) % 5 == 0, F.lit(0.0)).otherwise(F.lit(0.5)).alias("density_of_ocean"))
    return G.land_mask(G.load_masks(cells, {"warm": some}), ocean).select("yj", "xi", "n", "warm", "is_land")


def auxiliary_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ice types and snow from constants and options, with a day's merge of the records that have a freeboard."""
    e = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("segment_id"), F.col("event_id").alias("record_idx"), F.lit("2024-03-01").cast("date").alias("day"), F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("sea_ice_concentration"),
        F.when(F.col("event_id") % 6 > 0, F.col("value") / 100).alias("sea_ice_freeboard"),
    )
    fixed = {"snow_depth": 0.3, "snow_density": 320.0, "snow_depth_uncertainty": 0.05}
    old = Auxiliary([("sitype", "all_multi_year", {}), ("snow", "fixed", fixed)]).apply(e, {})
    young = Auxiliary([("sitype", "all_first_year", {}), ("snow", "fixed", {"snow_depth": 0.1, "snow_density": 300.0})]).apply(e, {})
    out = daily_merge([old.withColumn("kind", F.lit("old")), young.withColumn("kind", F.lit("young"))])
    return rounded(out.select("record_idx", "kind", "sea_ice_type", "sea_ice_type_uncertainty", "snow_depth", "snow_depth_uncertainty", "snow_density", "snow_density_uncertainty"))


def auxiliary_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ice fractions, snow by month and by day, and a land mask from rasters that are constant over their cells' days, at
    the cells that an equal-area grid gives the records."""
    from firnline.plans.aux_queries import GRID

    e = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("segment_id"), F.col("event_id").alias("record_idx"), F.lit("2024-02-29").cast("date").alias("day"), (F.col("event_id") % 360 - 180).cast("double").alias("longitude"),
        (F.lit(65.0) + F.pmod(F.col("event_id") * 7, F.lit(2400)) / 100.0).alias("latitude"), F.lit(4).alias("surface_flag"),
    )
    cells = spark.range(GRID.numx * GRID.numy).select((F.col("id") % GRID.numx).cast("int").alias("ix"), F.floor(F.col("id") / GRID.numx).cast("int").alias("iy"))
    kind = cells.select("ix", "iy", ((F.col("ix") * 11 + F.col("iy")) % 120 - 10).cast("double").alias("myi_percent"))
    months = F.explode(F.array(*[F.lit(m) for m in (1, 2, 3)])).alias("month")
    monthly = cells.select("ix", "iy", months).withColumns({"snow_depth": (F.col("ix") + F.col("month") * 10) / 100.0, "snow_depth_uncertainty": F.col("iy") * F.col("month") / 1000.0})
    daily = cells.select("ix", "iy", F.lit("0228").alias("month_day"), ((F.col("ix") - F.col("iy")) / 10.0).alias("snow_depth"))
    land = cells.filter("ix % 3 > 0").select("ix", "iy", (F.col("ix") % 3 - 1).alias("land"), (F.col("iy") * 1.5).alias("distance_to_coast"))
    months_out = Auxiliary([("sitype", "fraction", {"grid": GRID}), ("snow", "merged_monthly", {"grid": GRID}), ("mask", "land", {"grid": GRID})]).apply(e, {"sitype": kind, "snow": monthly, "landmask": land})
    by_day = Auxiliary([("snow", "day_of_year", {"grid": GRID})]).apply(e.select("segment_id", "record_idx", "day", "longitude", "latitude"), {"snow": daily})
    out = months_out.join(by_day.select("record_idx", F.col("snow_depth").alias("snow_of_day")), "record_idx")
    return rounded(out.select("record_idx", "sea_ice_type", "snow_depth", "snow_depth_uncertainty", "snow_of_day", F.col("surface_flag").cast("int").alias("surface_flag"), "distance_to_coast"))


def session_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming merge on the table: chains of events of a type with less than a minute between."""
    return chains(load(spark, sf_dir, "events").select("event_type", "ts"), "event_type", "ts", "60 seconds")


def daily_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("ts", "value", (F.col("user_id") % 10).alias("k"))
    out = grid_counts(e, F.col("k"), "ts", "1 day")
    return rounded(out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "cell", "n", "value_mean"), 5)


def _trajectory(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir, "event_type", "value").select(
        "user_id", "event_id", "ts", (F.col("value") - 50).alias("latitude"), F.when(F.col("event_type") == "view", 1).otherwise(7).alias("surface_type"),
        (F.col("event_id") % 2).cast("int").alias("radar_mode"), (F.col("user_id") % 5).alias("mission"),
    )


_LEVEL1 = {
    "custom_orbit": {"min_latitude": 5.0, "hemisphere": "north", "most_land": 1, "connect_seconds": 3600.0, "least_records": 2},
    "half_orbit": {"min_latitude": 10.0, "least_ocean": 2, "gap_seconds": 864000.0, "most_land": 2, "split_modes": True, "connect_seconds": 600.0},
    "full_orbit": {"min_latitude": 2.0, "gap_seconds": 432000.0, "most_land": 1, "connect_seconds": 60.0, "least_records": 2},
}


def _processed(spark, sf_dir, name: str) -> DataFrame:
    out = preprocess(_trajectory(spark, sf_dir), EVENTS, processor(name, **_LEVEL1[name]), None, "mission", "ts")
    return out.select("event_id", "segment_id", "surface_type")


def level1_custom_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _processed(spark, sf_dir, "custom_orbit")


def level1_half_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _processed(spark, sf_dir, "half_orbit")


def level1_full_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _processed(spark, sf_dir, "full_orbit")


def _products(spark, sf_dir) -> DataFrame:
    """A file for each user, with the variables of four products made of the events; every third event is a low-rate one."""
    e = events(spark, sf_dir, "value").withColumns({"pos": F.row_number().over(EVENTS.along) - 1, "t": F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 946684800.0})
    rows = F.array_sort(F.collect_list(F.struct("pos", "event_id", "t", "value")))
    e = e.groupBy("user_id").agg(rows.alias("high")).withColumn("low", F.filter("high", lambda r: r["pos"] % 3 == 0))
    of = lambda side, body: F.transform(side, body)
    high = {
        "time_20_ku": lambda r: r["t"], "time_20hz": lambda r: r["t"], "event": lambda r: r["event_id"], "lon_20_ku": lambda r: r["value"] * 2, "lat_20_ku": lambda r: r["value"], "alt_20_ku": lambda r: r["value"] + 700000,
        "lon_20hz": lambda r: r["value"] * 3 - 40, "lat_20hz": lambda r: r["value"] * 1.5, "alt_20hz": lambda r: r["value"], "window_del_20_ku": lambda r: r["value"] * 1e-6, "tracker_range_20_ku": lambda r: r["value"] * 10,
        "tracker_range_20hz": lambda r: r["value"] * 10, "pwr_waveform_20_ku": lambda r: F.array(r["value"], r["value"] * 2, F.lit(1.0), F.lit(2.0)), "ku_wf": lambda r: F.array(r["value"], F.lit(3.0)),
        "waveform_20_ku": lambda r: F.array(r["value"], F.lit(5.0), F.lit(6.0)), "echo_scale_factor_20_ku": lambda r: r["value"] / 7, "echo_scale_pwr_20_ku": lambda r: r["event_id"] % 4, "scale_factor_20_ku": lambda r: r["value"] / 5,
        "flag_mcd_20_ku": lambda r: r["event_id"] % 3 * 3000, "alt_state_flag_20hz": lambda r: r["event_id"] % 5, "instr_op_mode_20_ku": lambda r: r["event_id"] % 3, "op_mode": lambda r: r["event_id"] % 3,
    }
    low = {
        "time_cor_01": lambda r: r["t"], "time_01": lambda r: r["t"], "mod_dry_tropo_cor_01": lambda r: r["value"], "pole_tide_01": lambda r: r["value"] / 7, "surf_type_01": lambda r: r["event_id"] % 5,
        "off_nadir_roll_angle_pf_01": lambda r: r["value"] / 3, "mod_dry_tropo_cor": lambda r: r["value"], "surface_type": lambda r: r["event_id"] % 5,
    }
    return e.select("user_id", *[of("high", f).alias(c) for c, f in high.items()], *[of("low", f).alias(c) for c, f in low.items()])


def _adapted(spark, sf_dir, name: str) -> DataFrame:
    out = adapters.records(_products(spark, sf_dir), adapters.ADAPTERS[name], "user_id", {"event_id": "event"})
    return rounded(out.select(
        "event_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "mission", "longitude", "latitude", "altitude", V.total(F.col("waveform_power")).alias("power"),
        F.get("waveform_range", F.lit(0)).alias("first_range"), F.element_at("waveform_range", -1).alias("last_range"), "radar_mode", "is_valid", "surface_type", F.col("dry_troposphere").alias("dry"),
        (F.col("antenna_roll") if "antenna_roll" in out.columns else F.lit(None).cast("double")).alias("roll"),
    ), 5)


def adapted_cryosat2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapted(spark, sf_dir, "cryosat2")


def adapted_sentinel3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapted(spark, sf_dir, "sentinel3")


def adapted_ers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapted(spark, sf_dir, "ers")


def adapted_envisat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third product's variables under the second's names, with faults and a high-rate surface class."""
    files = _products(spark, sf_dir).withColumnsRenamed({"time_20hz": "time_20", "lon_20hz": "lon_20", "lat_20hz": "lat_20", "alt_20hz": "alt_20", "ku_wf": "waveform_fft_20_ku", "op_mode": "waveform_fault_id_20", "alt_state_flag_20hz": "surf_class_20"})
    out = adapters.records(files, adapters.ADAPTERS["envisat"], "user_id", {"event_id": "event"})
    return rounded(out.select("event_id", "longitude", "altitude", V.total(F.col("waveform_power")).alias("power"), F.element_at("waveform_range", -1).alias("last_range"), "radar_mode", "is_valid", "surface_type", F.col("geocentric_polar_tide").alias("pole_tide")), 5)


def _metres(spark, sf_dir) -> DataFrame:
    df = events(spark, sf_dir, "event_type", "value")
    return df.withColumns({
        "surface_type": F.when(F.col("event_type") == "purchase", 2).otherwise(1), "elevation": F.col("value") / 10, "mean_sea_surface": F.lit(1.0),
        "longitude": F.col("user_id") % 300 + F.row_number().over(EVENTS.along) * (F.col("user_id") % 7 + 1) / 1000.0, "latitude": F.lit(70.0),
    })


def record_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = footprint_spacing(_metres(spark, sf_dir), EVENTS)
    return rounded(out.select("event_id", "spacing"), 3)


def sea_level_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter width and distances in metres, by each segment's own spacing."""
    df = _metres(spark, sf_dir).withColumn("spacing", F.col("user_id") % 7 * 50.0 + 100.0)
    out = smoothed_linear(df, EVENTS, SeaLevel(filter_width_m=1000.0, u_dist=3000.0, max_dist=2000.0), spacing="spacing")
    return rounded(out.select("event_id", "sea_level_anomaly", "sea_level_anomaly_uncertainty", "tie_distance"), 8)


QUERIES = {
    f.__name__: f
    for f in (
        radar_geometry, echo_scaling, echo_backscatter, echo_ice_retracker, retracker_thresholds, retracked_surfaces, record_steps, combined_conditions, reflected_mean, candidate_files,
        files_of_period, files_of_day, chosen_cell_uncertainties, masked_cells, auxiliary_constants, auxiliary_rasters, session_chains, daily_cells, level1_custom_orbit, level1_half_orbit, level1_full_orbit, adapted_cryosat2, adapted_sentinel3, adapted_ers, adapted_envisat, record_spacing, sea_level_metres,
    )
}

_ORDER = "partition by user_id order by ts, event_id"
_W = "e as (select vec_id, list_transform(embedding, lambda x: abs(cast(x as double))) as w from embeddings)"
_B = "b as (select vec_id, cast(i as integer) as i, w[i + 1] as x, w[64 - i] as z from e, range(64) r(i))"
_P = "p as (select vec_id, max(x) as pk, min(case when x = m then i end) as pa from (select *, max(x) over (partition by vec_id) as m from b) group by 1)"


def _runs(source: str, keys: str, condition: str, out: str) -> str:
    """CTEs: source with cond and the number and length of each run of equal cond along the keys."""
    order = f"partition by {keys} order by ts, event_id"
    return f"""
        {out}_c as (select *, {condition} as cond from {source}),
        {out}_d as (select *, case when row_number() over ({order}) = 1 or lag(cond) over ({order}) is not distinct from cond then 0 else 1 end as ch from {out}_c),
        {out}_e as (select *, cast(sum(ch) over ({order} rows unbounded preceding) as bigint) as run from {out}_d),
        {out} as (select * exclude (ch), count(*) over (partition by {keys}, run) as len from {out}_e)
    """


def _level1_sql(name: str) -> str:
    o = _LEVEL1[name]
    ctes = ["t0 as (select user_id, event_id, ts, value - 50 as lat, case when event_type = 'view' then 1 else 7 end as surf, event_id % 2 as mode, user_id % 5 as mission from events)"]
    least = o.get("least_ocean", 0)
    ctes += [_runs("t0", "user_id", "surf = 1", "t1"), f"t2 as (select * exclude (cond, run, len, surf), case when cond and len < {least} then 7 else surf end as surf from t1)"]
    if name == "full_orbit":
        ctes += [_runs("t2", "user_id", f"abs(lat) >= {o['min_latitude']}", "t3"), "t4 as (select * exclude (cond, run, len), run as p0 from t3 where cond)"]
    else:
        keep = f" and lat >= 0" if o.get("hemisphere") == "north" else ""
        ctes.append(f"t4 as (select *, case when lat >= 0 then 0 else 1 end as p0 from t2 where abs(lat) >= {o['min_latitude']}{keep})")
    gap = o.get("gap_seconds", 1e15)
    along = "partition by user_id, p0 order by ts, event_id"
    ctes += [
        f"t5a as (select *, case when (epoch_us(ts) - lag(epoch_us(ts)) over ({along})) / 1e6 > {gap} then 1 else 0 end as g from t4)",
        f"t5 as (select * exclude (g), sum(g) over ({along} rows unbounded preceding) as p1 from t5a)",
    ]
    part = "partition by user_id, p0, p1"
    ctes += [
        f"t6a as (select *, max(surf = 1) over ({part} order by ts, event_id rows between unbounded preceding and current row) as b, max(surf = 1) over ({part} order by ts, event_id rows between current row and unbounded following) as a from t5)",
        "t6 as (select * exclude (a, b) from t6a where a and b)",
        _runs("t6", "user_id, p0, p1", "surf <> 1", "t7"),
        f"t8a as (select * exclude (cond, run, len), cond and len > {o['most_land']} as gone from t7)",
        f"t8b as (select *, case when gone and not coalesce(lag(gone) over ({part} order by ts, event_id), false) then 1 else 0 end as st from t8a)",
        f"t8c as (select * exclude (st), sum(st) over ({part} order by ts, event_id rows unbounded preceding) as p2 from t8b)",
        "t8 as (select * exclude (gone) from t8c where not gone)",
    ]
    if o.get("split_modes"):
        ctes += [_runs("t8", "user_id, p0, p1, p2", "mode", "t9a"), "t9 as (select * exclude (cond, run, len), run as p3 from t9a)"]
    else:
        ctes.append("t9 as (select *, 0 as p3 from t8)")
    keys = "user_id, p0, p1, p2, p3"
    region = "case when p0 = 0 then 'north' else 'south' end" if name != "full_orbit" else "p0"
    ctes += [
        f"s0 as (select mission, {keys}, min(ts) as start_ts, max(ts) as stop_ts from t9 group by all)",
        "s1 as (select *, max(epoch_us(stop_ts)) over (partition by mission order by start_ts, stop_ts rows between unbounded preceding and 1 preceding) as latest from s0)",
        f"s2 as (select *, sum(case when (epoch_us(start_ts) - latest) / 1e6 <= {o['connect_seconds']} then 0 else 1 end) over (partition by mission order by start_ts, stop_ts rows unbounded preceding) - 1 as chain from s1)",
        f"s3 as (select *, row_number() over (partition by mission, chain order by start_ts, stop_ts, user_id, {region}, p1, p2, p3) as nth from s2)",
        "s4 as (select *, max(stop_ts) over (partition by mission, chain order by nth rows between unbounded preceding and 1 preceding) as seen from s3)",
        f"m as (select t9.event_id, t9.surf, t9.mission || '/' || cast(chain as bigint) as segment_id from t9 join s4 using (mission, {keys}) where seen is null or ts > seen)",
    ]
    return "with " + ",\n".join(ctes) + f"\nselect event_id, segment_id, cast(surf as integer) as surface_type from m qualify count(*) over (partition by segment_id) >= {o.get('least_records', 1)}"


_AXES = (6378136.3, 6378137.0, 6378136.3 * (1 - 1 / 298.257), 6378137.0 * (1 - 1 / 298.257223563))
_SIGMA = (4 * math.pi) ** 3 * 2.0 / (0.022**2 * 18197.0**2)
_STEP = "(299792458.0::double / 1280000000.0::double)"
_KNEE = lambda share: f"(select vec_id, {share}::double * sqrt(sum(x**4) / sum(x**2)) as level from b where i >= 2 group by 1)"

SQL = {
    "radar_geometry": f"""
        with k as (select *, l_quantity * 1000 + 700000 as r, l_tax * 100 + 7000 as v from lineitem),
        a as (select *, 2 * sqrt({299792458.0 * 2.8e-9!r}::double * r / (1 + r / 6371000.0::double)) * 1.5::double * (0.022::double * r / (2 * v * 0.001::double)) as area from k)
        select l_orderkey, l_linenumber, round(area / 1e6, 5) + 0.0 as footprint,
               round(10 * log10((l_discount + 0.01::double) * 1e-12::double / l_quantity) + 10 * log10({_SIGMA!r}::double * r ** 4 / area) + 0.5, 5) + 0.0 as sigma0,
               cast(floor(l_extendedprice) as bigint) // 840 as sub_cycle, cast(floor(l_extendedprice) as bigint) % 840 as rel_track,
               round(sqrt(l_quantity ** 2 + l_tax ** 2 + l_discount ** 2), 5) + 0.0 as velocity, round(degrees(acos(least(cos(radians(l_discount * 10)) * cos(radians(l_tax * 10)), 1.0))), 5) + 0.0 as mispointing,
               round(-({_AXES[1] - _AXES[0]!r}::double * cos(radians(l_quantity)) ** 2 + {_AXES[3] - _AXES[2]!r}::double * sin(radians(l_quantity)) ** 2), 5) + 0.0 as delta_h,
               round(l_extendedprice - 63.0::double * 0.47::double - 3 * l_tax, 5) + 0.0 as window_delay,
               round(case when l_quantity > 50 then 0 else least(greatest(2 + l_quantity ** (-0.5), 0.1), 2.1) end, 5) + 0.0 as nu,
               round(l_tax * 1e-6::double * 149896229.0::double + l_extendedprice, 5) + 0.0 as epoch_range, round(l_extendedprice * l_quantity ** (-l_tax) + l_discount, 5) + 0.0 as decay
        from a
    """,
    "echo_scaling": f"""
        with {_W}, {_B}, {_P}, c as (select vec_id, sum(x) as t, avg(x) filter (i < 11) as noise, avg(x) as m, sum((x - z) ** 2) as res, avg((x - z) ** 2) as mse from b group by 1),
        d as (select vec_id, sum(greatest(x - noise, 0)) as clean, sum((x - m) ** 2) as tot, max(greatest(x - noise, 0)) as cpk from b join c using (vec_id) group by 1),
        q as (select b.vec_id, avg(x) filter (i between pa - 3 and pa - 1) as l, avg(x) filter (i between pa + 1 and pa + 3) as r, avg(greatest(x - noise, 0)) filter (i between pa + 10 and pa + 20) as lt,
                     sum(x) filter (i >= greatest(least(pa - 16, 24), 0) and i < greatest(least(pa - 16, 24), 0) + 40) as cut from b join p using (vec_id) join c using (vec_id) group by 1)
        select vec_id, round(t * 2.5 * 1e-9::double * 8, 7) + 0.0 as watts, round(vec_id / 7.0::double - 44.5 * 0.47::double + case when vec_id % 2 = 0 then 0.25 else 0 end, 7) + 0.0 as first_range,
               round(vec_id / 7.0::double + 18.5 * 0.47::double + case when vec_id % 2 = 0 then 0.25 else 0 end, 7) + 0.0 as last_range,
               round(case when pa >= 3 then pk / l * 3 end, 7) + 0.0 as left_peakiness, round(case when pa + 3 < 64 then pk / r * 3 end, 7) + 0.0 as right_peakiness, round(clean, 7) + 0.0 as clean,
               round(100 * sqrt(mse) / pk, 7) + 0.0 as misfit, round(1 - res / tot, 7) + 0.0 as r2, cast(case vec_id % 3 when 0 then 72 when 1 then 64 else 40 end as integer) as bins,
               round(case vec_id % 3 when 2 then cut else t end, 7) + 0.0 as resampled, round(90 - (vec_id / 1000.0::double + 0.75), 7) + 0.0 as angle, round(case when pa + 20 < 64 then lt / cpk end, 7) + 0.0 as late_tail
        from c join d using (vec_id) join p using (vec_id) join q using (vec_id)
    """,
    "echo_backscatter": f"""
        with {_W}, {_B}, n as (select vec_id, avg(x) as n from b where i < 11 group by 1), c as (select vec_id, max(x) as pk, sqrt(sum(greatest(x - n, 0) ** 4) / sum(greatest(x - n, 0) ** 2)) as amp from b join n using (vec_id) group by 1),
        k as (select *, 720000.0::double + vec_id as r, 20.0 + vec_id % 3 as sent from c),
        a as (select *, 2 * sqrt({299792458.0 * 2.8e-9!r}::double * r / (1 + r / 6371000.0::double)) * (0.022::double * r / (2 * 7500.0::double * 0.001::double)) as sar, pi() * (r * 299792458.0::double / 320000000.0::double) / 1e6 as lrm from k)
        select vec_id, round(case vec_id % 4 when 0 then 10 * log10(amp / sent) + 10 * log10({_SIGMA / 2!r}::double * r ** 4 / lrm) + 0.1 when 1 then 10 * log10(pk / sent) + 10 * log10({_SIGMA / 2!r}::double * r ** 4 / sar) + 0.2
                              when 2 then 10 * log10(pk / sent) + 10 * log10({_SIGMA / 2!r}::double * r ** 4 / sar) - 0.3 end, 6) + 0.0 as sigma0,
               cast(case vec_id % 4 when 0 then 1 when 2 then 3 end as integer) as kind from a
    """,
    "echo_ice_retracker": f"""
        with {_W}, {_B}, hi as {_KNEE(0.6)}, lo as {_KNEE(0.3)}, n as (select *, lag(x) over (partition by vec_id order by i) as px from b),
        h as (select n.vec_id, min(i) as i1 from n join hi using (vec_id) where i >= 3 and x > level group by 1), l as (select n.vec_id, min(i) as i1 from n join lo using (vec_id) where i >= 3 and x > level group by 1),
        hb as (select * from (select n.vec_id, i - 1 + (level - px) / (x - px) as bin from n join h on n.vec_id = h.vec_id and i = i1 join hi on n.vec_id = hi.vec_id) where bin between 0 and 63),
        lb as (select n.vec_id, i - 1 + (level - px) / (x - px) as bin from n join l on n.vec_id = l.vec_id and i = i1 join lo on n.vec_id = lo.vec_id),
        tm as (select b.vec_id, avg(x) as m from b join hb using (vec_id) where i >= floor(bin) + 3 group by 1),
        ts as (select b.vec_id, case when count(*) >= 2 then sqrt(greatest(regr_syy(x / m, i) - regr_sxy(x / m, i) ** 2 / regr_sxx(x / m, i), 0) / count(*)) end as shape
               from b join hb using (vec_id) join tm using (vec_id) where i >= floor(bin) + 3 group by 1),
        f as (select e.vec_id, hb.bin, hb.bin - lb.bin as lew, shape from e left join hb using (vec_id) left join lb using (vec_id) left join ts using (vec_id))
        select vec_id, round(bin, 6) + 0.0 as bin, round(0.0048::double * 149896229.0::double - 32 * {_STEP} + bin * {_STEP}, 6) + 0.0 as range, round(lew, 6) + 0.0 as leading_edge_width,
               round(shape, 6) + 0.0 as tail_shape, coalesce(lew < 4 and shape < 2 and bin > 1.5 and bin < 60, false) as valid from f
    """,
    "retracker_thresholds": """
        select l_orderkey, l_linenumber, 0.4::double as plain, 0.5::double as fixed, round(0.1 + 0.01::double * l_quantity - 0.0001::double * l_quantity ** 2, 6) + 0.0 as by_sigma,
               round(case when l_discount * 10 > 0.5 then 0.3 - 0.002::double * l_quantity else 0.2 + 0.01::double * l_quantity end, 6) + 0.0 as by_type,
               round(0.3 + 0.5::double * l_tax - 0.2::double * l_tax ** 2 + 0.01::double * l_quantity, 6) + 0.0 as by_plane, round(l_extendedprice, 6) + 0.0 as given from lineitem
    """,
    "retracked_surfaces": f"""
        with s as (select *, {SURFACE_SQL} as surf from lineitem), r as (select *, case when l_quantity > 5 then case surf when 2 then l_quantity when 4 then l_quantity * 2 end end as rng from s)
        select l_orderkey, l_linenumber, round(rng, 6) + 0.0 as retracked_range, round(l_extendedprice - rng, 6) + 0.0 as elevation, round(case when rng is not null then l_tax end, 6) + 0.0 as elevation_uncertainty,
               surf in (2, 4) and rng is null as retracker_failed, cast(case when surf in (2, 4) and rng is null then 8 else surf end as integer) as surface_type from r
    """,
    "record_steps": f"""
        with k as (select *, case when event_id % 5 > 0 then event_id % 7 / 10.0::double end as tide, event_id % 11 / 10.0::double as dry,
                          lag(value) over ({_ORDER}) as v0, lead(value) over ({_ORDER}) as v2 from events)
        select event_id, round(dry, 6) + 0.0 as taken, cast(null as double) as lost, cast(event_id % 3 + 1 as integer) as instrument_mode, round(value - tide - dry, 6) + 0.0 as elevation,
               round(tide + dry, 6) + 0.0 as total_range_correction, round(value / 100, 6) + 0.0 as sea_ice_freeboard, 0.1::double as sea_ice_freeboard_uncertainty,
               round(case when v0 is null or v2 is null then value else (v0 + value + v2) / 3 end, 6) + 0.0 as smooth, cast(1 + case when tide is null then 32 else 0 end as integer) as flag from k
    """,
    "combined_conditions": f"""
        with k as (select *, max(case when event_type = 'purchase' then 1 else 0 end) over ({_ORDER} rows between unbounded preceding and current row) as b,
                          max(case when event_type = 'purchase' then 1 else 0 end) over ({_ORDER} rows between current row and unbounded following) as a from events)
        select event_id, value > 10 and event_id % 2 = 0 and event_type <> 'click' as both, value > 90 or event_type = 'click' as either, round(case when event_id % 4 < 2 then value end, 6) + 0.0 as sla,
               round(case when event_id % 4 < 2 then value / 10 end, 6) + 0.0 as sla_uncertainty, round(case when event_id % 9 <= 5 or (a = 1 and b = 1) then value end, 6) + 0.0 as far from k
    """,
    "reflected_mean": f"""
        select event_id, round((coalesce(lag(value) over ({_ORDER}), value) + value + coalesce(lead(value) over ({_ORDER}), value)) / 3, 6) + 0.0 as smooth from events
    """,
    "candidate_files": """
        with f as (select user_id, min(value - 50) as lo, max(value - 50) as hi, avg(case when event_type = 'view' then 100.0 else 0.0 end) as pct from events group by 1)
        select user_id, round(lo, 6) + 0.0 as lat_min, round(hi, 6) + 0.0 as lat_max, user_id as orbit, round(pct, 3) + 0.0 as percent
        from f where pct > 1e-6 and greatest(abs(lo), abs(hi)) >= 45 and hi > 0
    """,
    "files_of_period": """
        with f as (select user_id, min(ts) as a, max(ts) as b from events group by 1)
        select user_id, '/base/v1/north/' || strftime(a, '%Y/%m') || '/f' || user_id || '.nc' as path from f
        where user_id % 2 = 0 and strftime(a, '%Y/%m') between '2023/12' and '2024/01' and a <= timestamp '2024-01-12' and b >= timestamp '2024-01-10'
    """,
    "files_of_day": """
        with f as (select user_id, min(ts) as a, max(ts) as b from events group by 1)
        select user_id from f where cast(a as date) = date '2024-01-02' or (cast(a as date) = date '2024-01-01' and cast(b as date) >= date '2024-01-02')
    """,
    "chosen_cell_uncertainties": """
        with c as (select s_suppkey, least(greatest((s_suppkey % 7 + 1) / 50.0::double, 0.04), 0.1) as r, case when s_suppkey % 11 > 0 then (s_suppkey % 13 + 1) / 20.0::double end as frb, (s_suppkey % 5 + 1) / 10.0::double as sd,
                          (s_suppkey % 3 + 1) / 30.0::double as sdu, (s_suppkey % 9 + 1) * 10 + 250.0::double as sn, (s_suppkey % 4 + 1) * 8.0::double as snu, (s_suppkey % 6 + 1) * 5 + 880.0::double as ice, (s_suppkey % 8 + 1) * 4.0::double as iceu,
                          s_suppkey % 17 > 0 as has, (s_suppkey % 19 + 1) / 90.0::double as r2 from supplier),
        f as (select *, case when frb is not null then sqrt((0.22 * sdu) ** 2 + r ** 2) end as fu, case when frb is not null then sqrt((0.3 * sdu) ** 2 + r2 ** 2) end as fu2 from c),
        t as (select *, case when has then sqrt((1024 / (1024 - ice) * fu) ** 2 + ((frb * 1024 + sd * sn) / (1024 - ice) ** 2 * iceu) ** 2 + (sn / (1024 - ice) * sdu) ** 2 + (sd / (1024 - ice) * snu) ** 2) end as su,
                     case when has then sqrt((1027 / (1027 - ice) * fu2) ** 2 + ((frb * 1027 + sd * sn) / (1027 - ice) ** 2 * iceu) ** 2 + (sn / (1027 - ice) * sdu) ** 2 + (sd / (1027 - ice) * snu) ** 2) end as su2 from f),
        u as (select *, case when su is not null then least(greatest(su, 0.5), 2.0) end as s from t)
        select s_suppkey, round(r, 6) + 0.0 as radar_freeboard_l3_uncertainty, round(fu, 6) + 0.0 as sea_ice_freeboard_l3_uncertainty, round(s, 6) + 0.0 as sea_ice_thickness_l3_uncertainty,
               round(sqrt(s ** 2 + fu ** 2), 6) + 0.0 as sea_ice_draft_l3_uncertainty, round(fu2, 6) + 0.0 as other_frb, round(su2, 6) + 0.0 as other_sit from u
    """,
    "masked_cells": """
        with c as (select cast(l_orderkey % 25 as integer) as yj, cast(l_partkey % 25 as integer) as xi, count(*) as n from lineitem group by 1, 2)
        select yj, xi, n, case when (yj + xi) % 3 > 0 then yj * 2 end as warm, case when xi % 4 > 0 then (yj * xi) % 5 = 0 end as is_land from c
    """,
    "auxiliary_constants": """
        with r as (select event_id as record_idx, case when event_id % 4 > 0 then value end as sic from events where event_id % 6 > 0 and value is not null)
        select record_idx, 'old' as kind, case when sic > 0 then 1.0::double else 0.0::double end as sea_ice_type, 0.0::double as sea_ice_type_uncertainty, 0.3::double as snow_depth, 0.05::double as snow_depth_uncertainty,
               320.0::double as snow_density, 0.0::double as snow_density_uncertainty from r
        union all select record_idx, 'young', 0.0, 0.0, 0.1, 0.0, 300.0, 0.0 from r
    """,
    "session_chains": """
        with g as (select event_type, ts, case when ts < lag(ts) over (partition by event_type order by ts) + interval 60 second then 0 else 1 end as c from events),
        s as (select *, sum(c) over (partition by event_type order by ts rows unbounded preceding) as k from g)
        select event_type, min(ts) as start_time, max(ts) as stop_time, count(*) as n_records from s group by event_type, k
    """,
    "daily_cells": """
        select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, user_id % 10 as cell, count(value) as n, round(avg(value), 5) + 0.0 as value_mean from events group by 1, 2
    """,
    "level1_custom_orbit": _level1_sql("custom_orbit"),
    "level1_half_orbit": _level1_sql("half_orbit"),
    "level1_full_orbit": _level1_sql("full_orbit"),
    "record_spacing": f"""
        with k as (select event_id, user_id, ts, user_id % 300 + row_number() over ({_ORDER}) * (user_id % 7 + 1) / 1000.0::double as lon, count(*) over (partition by user_id) as n, row_number() over ({_ORDER}) as nth from events),
        d as (select *, 2 * 6371000.0::double * asin(sqrt(cos(radians(70.0)) ** 2 * sin(radians(lead(lon) over ({_ORDER}) - lon) / 2) ** 2)) as step from k)
        select event_id, round(first_value(step) over ({_ORDER}), 3) + 0.0 as spacing from d
    """,
}


#: High-rate rows h with the low-rate rows around them: i0, i1 positions among the file's, w the weight of the later.
_LOW = f"""
    h as (select user_id, event_id, ts, epoch_us(ts) / 1e6 - 946684800.0 as t, value as v, row_number() over ({_ORDER}) - 1 as pos, count(*) over (partition by user_id) as n from events),
    l as (select user_id, t, v, event_id, pos // 3 as k, count(*) over (partition by user_id) as m, max(t) over (partition by user_id) as t_max from h where pos % 3 = 0),
    i as (select h.event_id, max(l.k) as k, min(t_max) as t_max, min(m) as m from h join l on h.user_id = l.user_id and l.t <= h.t group by 1),
    a as (select h.*, i.k, coalesce((h.t - l0.t) / nullif(l1.t - l0.t, 0), 0) as w, l0.v as v0, l1.v as v1, l0.event_id as e0, l1.event_id as e1
          from h left join i on h.event_id = i.event_id and h.t <= i.t_max left join l l0 on h.user_id = l0.user_id and i.k = l0.k left join l l1 on h.user_id = l1.user_id and i.k + 1 = l1.k),
    b as (select *, case when k is null then null when w = 0 then v0 else v0 + w * (v1 - v0) end as low, case when k is null then null when w > 0.5 then e1 else e0 end as near from a)
"""
_TYPE = lambda code: f"cast(case {code} when 0 then 1 when 1 then 5 when 2 then 6 when 3 then 7 else 0 end as integer)"
_R = lambda x: f"round({x}, 5) + 0.0"
SQL["adapted_cryosat2"] = f"""
    with {_LOW} select event_id, strftime(ts - interval 37 second, '%Y-%m-%d %H:%M:%S') as time, 'cryosat2' as mission, {_R('v * 2')} as longitude, {_R('v')} as latitude, {_R('v + 700000')} as altitude,
        {_R('(v * 3 + 3) * (v / 7 * 2 ** (event_id % 4))')} as power, {_R(f'v * 1e-6::double * 149896229.0::double - 2 * {_STEP}')} as first_range, {_R(f'v * 1e-6::double * 149896229.0::double + {_STEP}')} as last_range,
        cast(event_id % 3 as integer) as radar_mode, event_id % 3 * 3000 <= 4096 as is_valid, {_TYPE('near % 5')} as surface_type, {_R('low')} as dry, cast(null as double) as roll from b
"""
SQL["adapted_sentinel3"] = f"""
    with {_LOW} select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as time, 'sentinel3' as mission, {_R('v * 2')} as longitude, {_R('v')} as latitude, {_R('v + 700000')} as altitude, {_R('(v + 11) * v / 5')} as power,
        {_R('v * 10 - 43 * 0.234212857813::double')} as first_range, {_R('v * 10 - 41 * 0.234212857813::double')} as last_range, cast(case when event_id % 3 = 0 then 0 else 1 end as integer) as radar_mode, true as is_valid,
        {_TYPE('near % 5')} as surface_type, {_R('low')} as dry, {_R('low / 3')} as roll from b
"""
SQL["adapted_ers"] = f"""
    with {_LOW}, g as (select h.*, l.v as lv, l.event_id as le, abs(h.v * 1.5) <= 90 and abs(h.v * 3 - 40) <= 180 as ok from h join (select user_id, max(m) as mm from l group by 1) using (user_id) left join l on h.user_id = l.user_id and l.k = cast(floor(h.pos * mm / h.n) as integer))
    select event_id, strftime(ts - interval 3652 day, '%Y-%m-%d %H:%M:%S') as time, 'ers2' as mission, {_R('case when ok then (v * 3 - 40 + 180) - 360 * floor((v * 3 - 40 + 180) / 360) - 180 end')} as longitude, {_R('case when ok then v * 1.5 end')} as latitude,
        {_R('case when ok then v end')} as altitude, {_R('v + 3')} as power, {_R('v * 10 - 32.5 * 0.4545::double')} as first_range, {_R('v * 10 - 31.5 * 0.4545::double')} as last_range, cast(0 as integer) as radar_mode,
        event_id % 5 in (2, 3) as is_valid, {_TYPE('le % 5')} as surface_type, {_R('lv')} as dry, cast(null as double) as roll from g
"""
SQL["adapted_envisat"] = f"""
    with {_LOW} select event_id, {_R('v * 3 - 40')} as longitude, {_R('v')} as altitude, {_R('v + 3')} as power, {_R('v * 10 - 62 * 0.4684::double')} as last_range, cast(0 as integer) as radar_mode, event_id % 3 = 0 as is_valid,
        {_TYPE('event_id % 5')} as surface_type, {_R('low / 7')} as pole_tide from b
"""


def _metres_sql() -> str:
    return f"""
        with p as (select *, row_number() over ({_ORDER}) - 1 as pos, count(*) over (partition by user_id) as n, event_type = 'purchase' as tie, user_id % 7 * 50.0::double + 100.0 as sp,
                          case when event_type = 'purchase' then value / 10 - 1 end as raw from events),
        h as (select *, least(pos, n - 1 - pos, cast((floor(floor(1000.0 / sp) / 2) * 2 + 1 - 1) / 2 as integer)) as h from p),
        s1 as (select a.event_id, a.user_id, a.pos, a.n, a.h, a.sp, a.ts, case when a.tie then avg(b.raw) end as s1 from h a join h b on a.user_id = b.user_id and b.pos between a.pos - a.h and a.pos + a.h group by a.event_id, a.user_id, a.pos, a.n, a.h, a.sp, a.ts, a.tie),
        g as (select *, last_value(case when s1 is not null then pos end ignore nulls) over b as lp, last_value(s1 ignore nulls) over b as ly,
                     first_value(case when s1 is not null then pos end ignore nulls) over a as rp, first_value(s1 ignore nulls) over a as ry from s1
              window b as ({_ORDER} rows between unbounded preceding and current row), a as ({_ORDER} rows between current row and unbounded following)),
        s2 as (select *, coalesce(case when s1 is not null then s1 when lp is not null and rp is not null then ly + (pos - lp)::double / (rp - lp) * (ry - ly) end, ly, ry) as s2,
                      least(coalesce(pos - lp, n), coalesce(rp - pos, n)) * sp as dist from g),
        s3 as (select a.event_id, a.dist, avg(b.s2) as s3 from s2 a join s2 b on a.user_id = b.user_id and b.pos between a.pos - a.h and a.pos + a.h group by 1, 2),
        s4 as (select event_id, dist, case when dist <= 2000 then s3 end as sla from s3)
        select event_id, round(sla, 8) + 0.0 as sea_level_anomaly, round(case when sla is not null then 0.02 + 0.08::double * least(dist / 3000.0::double, 1) ** 2 end, 8) + 0.0 as sea_level_anomaly_uncertainty,
               round(dist, 8) + 0.0 as tie_distance from s4
    """


def _rasters_sql() -> str:
    from firnline.plans.aux_queries import SQL as known

    at = known["auxiliary_chain"]
    head = at[: at.index("c as (select *, ix between")].rstrip().rstrip(",")  # the records' cells
    return head + """,
        c as (select *, ix between 0 and 19 and iy between 0 and 19 as inside from x)
        select event_id as record_idx, round(case when inside then greatest(((ix * 11 + iy) % 120 - 10) / 100.0::double, 0) end, 6) + 0.0 as sea_ice_type,
               round(case when inside then (ix + 20) / 100.0::double * (1 - 14 / 29.0::double) + (ix + 30) / 100.0::double * (14 / 29.0::double) end, 6) + 0.0 as snow_depth,
               round(case when inside then iy * 2 / 1000.0::double * (1 - 14 / 29.0::double) + iy * 3 / 1000.0::double * (14 / 29.0::double) end, 6) + 0.0 as snow_depth_uncertainty,
               round(case when inside and ix >= iy then (ix - iy) / 10.0::double end, 6) + 0.0 as snow_of_day,
               cast(case when inside and ix % 3 = 2 then 7 when inside and ix % 3 = 1 then 1 else 4 end as integer) as surface_flag, round(case when inside and ix % 3 > 0 then iy * 1.5::double end, 6) + 0.0 as distance_to_coast from c
    """


SQL["sea_level_metres"] = _metres_sql()
SQL["auxiliary_rasters"] = _rasters_sql()
