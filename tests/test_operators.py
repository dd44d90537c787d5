import datetime
import random

import pytest
from pyspark.sql import functions as F

from firnline.functions.geodesy import Grid
from firnline.operators import filters, grid, segments, windows
from firnline.operators.windows import Track
from firnline.plans.products import GriddedProduct, daily_product, periods
from firnline.sources import manifest, records, sinks
from firnline.streaming import sessions

T = Track()


def track(spark, values, segment="a"):
    return spark.createDataFrame([(segment, i, v) for i, v in enumerate(values)], "segment_id string, record_idx int, x double")


def ordered(df, column):
    return [r[column] for r in df.orderBy("segment_id", "record_idx").collect()]


GAPPY = [None, None, 1.0, None, 3.0, None, None, 6.0, None]


def test_three_fill_policies(spark):
    df = track(spark, GAPPY).withColumn("pos", F.col("record_idx").cast("double"))
    assert ordered(df.withColumn("y", windows.fill_gaps(T, F.col("x"), F.col("pos"))), "y") == [None, None, 1, 2, 3, 4, 5, 6, None]
    assert ordered(df.withColumn("y", windows.fill_gaps(T, F.col("x"), F.col("pos"), "hold")), "y") == [1, 1, 1, 2, 3, 4, 5, 6, 6]
    assert ordered(windows.extrapolate_gaps(df, T, "x", "pos", "y"), "y") == [-1, 0, 1, 2, 3, 4, 5, 6, 7]
    empty = track(spark, [None, None]).withColumn("pos", F.col("record_idx").cast("double"))
    assert ordered(windows.extrapolate_gaps(empty, T, "x", "pos", "y"), "y") == [0, 0]


def test_fill_is_identity_without_gaps(spark):
    df = track(spark, [3.0, 1.0, 2.0])
    assert ordered(df.withColumn("y", windows.fill_gaps(T, F.col("x"), F.col("record_idx"), "hold")), "y") == [3, 1, 2]


def test_rolling_by_spacing_matches_brute_force(spark):
    random.seed(3)
    values = [None if random.random() < 0.2 else random.uniform(1e5, 1e5 + 10) for _ in range(60)]
    df = track(spark, values).withColumn("w", (F.col("record_idx") % 4 * 2 + 1).cast("int"))
    out = windows.rolling_by_spacing(df, T, "x", "w").orderBy("record_idx").collect()
    for i, r in enumerate(out):
        h = (i % 4 * 2 + 1 - 1) // 2
        part = [v for v in values[max(0, i - h) : i + h + 1] if v is not None]
        if part:
            assert abs(r["x_rolling_mean"] - sum(part) / len(part)) < 1e-6
        else:
            assert r["x_rolling_mean"] is None
        if len(part) > 1:
            m = sum(part) / len(part)
            assert abs(r["x_rolling_sdev"] - (sum((v - m) ** 2 for v in part) / (len(part) - 1)) ** 0.5) < 1e-5


def test_box_smooth_keeps_constants(spark):
    for window in (5, 99):
        out = ordered(windows.box_smooth(track(spark, [2.5] * 40), T, "x", window), "x_smooth")
        assert all(abs(v - 2.5) < 1e-9 for v in out)


def test_reflecting_mean(spark):
    values = [1.0, 5.0, 2.0, 8.0, 3.0]
    out = ordered(windows.uniform_reflect(track(spark, values), T, "x", 3, "y"), "y")
    padded = [1.0, *values, 3.0]
    assert [round(v, 9) for v in out] == [round(sum(padded[i : i + 3]) / 3, 9) for i in range(5)]


def test_islands_partition_rows(spark):
    runs = windows.run_lengths(track(spark, [1.0, 1.0, None, None, 2.0, 1.0]), T, "x").orderBy("island").collect()
    assert [(r["value"], r["start"], r["length"]) for r in runs] == [(1.0, 0, 2), (None, 2, 2), (2.0, 4, 1), (1.0, 5, 1)]


def test_distance_without_flags_is_the_length(spark):
    df = track(spark, [0.0] * 4).withColumn("d", windows.flag_distance(T, F.lit(False), F.col("record_idx")))
    assert ordered(df, "d") == [4, 4, 4, 4]


def test_time_gaps_are_filled(spark):
    t0 = datetime.datetime(2020, 1, 1)
    rows = [("a", i, t0 + datetime.timedelta(seconds=s), float(s)) for i, s in enumerate([0, 1, 2, 6, 7])]
    df = spark.createDataFrame(rows, "segment_id string, record_idx int, time timestamp, x double")
    out = segments.fill_time_gaps(df, T, "time", ["x"]).orderBy("time").collect()
    assert [round(r["x"], 6) for r in out] == [0, 1, 2, 3, 4, 5, 6, 7]
    assert [r["is_inserted"] for r in out] == [False] * 3 + [True] * 3 + [False] * 2


def test_trim_drops_segments_without_a_hit(spark):
    df = track(spark, [0.0, 1.0, 0.0, 1.0, 0.0]).union(track(spark, [0.0, 0.0], "b"))
    out = segments.trim_to(df, T, F.col("x") == 1).orderBy("record_idx").collect()
    assert [(r["segment_id"], r["record_idx"]) for r in out] == [("a", 1), ("a", 2), ("a", 3)]


def test_quality_flag_rejects_unknown_rules():
    with pytest.raises(ValueError):
        grid.quality_flag(F.lit(1.0), {"platform": {"source": "x"}})


def test_valid_range_nulls_pairs_and_ignores_null_sources(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.1), (9.0, 5.0, 0.1), (None, 5.0, 0.1)], "s double, t double, t_uncertainty double")
    out = filters.valid_range(df, "s", 0.0, 8.0, ["t"], "hit").collect()
    assert [(r["t"], r["t_uncertainty"], r["hit"]) for r in out] == [(5.0, 0.1, False), (None, None, True), (5.0, 0.1, False)]


def test_gridded_product(spark):
    rows = [("s", i, datetime.datetime(2020, 1, 1 + i % 3), 10.0 + i * 0.001, 75.0, 4 if i % 2 else 2, 1.0 + i % 3, 0.1, 90.0) for i in range(12)]
    df = spark.createDataFrame(rows, "segment_id string, record_idx int, time timestamp, longitude double, latitude double, surface_type int, sea_ice_thickness double, radar_freeboard_uncertainty double, sea_ice_concentration double")
    methods = {"sea_ice_thickness": "average", "latitude": "average", "sea_ice_concentration": "average", "absent": "average"}
    product = GriddedProduct(Grid("nh"), methods, 2, prefilter="sea_ice_thickness", period_days=10, quality_rules={"n_waveforms": {"source": "n_total_waveforms", "threshold": [5], "target": [1]}})
    out = product.cells(df, T, "2020-01-01").collect()
    assert sum(r["n_total_waveforms"] for r in out) == 12
    assert {r["status_flag"] for r in out} == {5} and all(r["absent"] is None for r in out)
    assert abs(out[0]["lead_fraction"] + out[0]["seaice_fraction"] - 1) < 1e-9


def test_period_segments(spark):
    assert [(str(r["start"]), str(r["stop"])) for r in periods("2020-01-30", "2020-03-02", "month", spark).collect()] == [
        ("2020-01-30", "2020-01-31"), ("2020-02-01", "2020-02-29"), ("2020-03-01", "2020-03-02"),
    ]


def test_round_trip_of_sinks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([("2020", 1.0, 5), ("2021", float("nan"), None)], "year string, x double, k int")
    sinks.write_records(records.missing_to_null(df), str(tmp_path / "p"), ["year"], fill=True)
    back = records.scan(spark, str(tmp_path / "p"), {"x": "x", "k": "k", "gone": "gone"}, {"k": -1}).orderBy("x").collect()
    assert [(r["x"], r["k"], r["gone"]) for r in back] == [(None, None, None), (1.0, 5, None)]
    assert manifest.list_files(spark, str(tmp_path / "p"), "*.parquet").count() >= 2


def test_daily_union_fills_columns(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "sea_ice_freeboard double, a double")
    b = spark.createDataFrame([(None, 3.0), (4.0, 5.0)], "sea_ice_freeboard double, b double")
    assert daily_product([a, b]).count() == 2


def test_streaming_chains_match_batch(spark, tmp_path):
    t0 = datetime.datetime(2020, 1, 1)
    rows = [("p", t0 + datetime.timedelta(seconds=s)) for s in (0, 5, 9, 40, 41, 100000)]
    df = spark.createDataFrame(rows, "platform string, time timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = {(r["start_time"], r["n_records"]) for r in sessions.chains(df, "platform", "time").collect()}
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = sessions.write_batches(sessions.chains(stream, "platform", "time"), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(60)
    done = {(r["start_time"], r["n_records"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert done and done <= batch


def test_models_are_batched_and_bounded(spark):
    import numpy as np

    from firnline.operators import models

    power = [0.0] * 20 + [i / 10 for i in range(11)] + [0.5] * 33
    df = spark.createDataFrame([(1, power, [float(i) for i in range(64)]), (2, None, None), (3, [0.0] * 64, [0.0] * 64)], "k long, w array<double>, r array<double>")
    udf = models.predicted_threshold(lambda: lambda windows: windows.sum(axis=1), 0.1, 0.9)
    assert [r[0] for r in df.orderBy("k").select(udf("w")).collect()] == [0.9, None, None]

    def fit(w, r):
        if w.max() <= 0:
            raise ValueError("no power")
        return {"top": float(r[int(w.argmax())]), "misfit": 1.0}

    out = models.fit_waveforms(df, ["k"], "w", "r", fit, ["top", "misfit"], most=5.0).orderBy("k").collect()
    assert [r["top"] for r in out] == [30.0, None, None]
    assert [r["top"] for r in models.fit_waveforms(df, ["k"], "w", "r", fit, ["top", "misfit"], most=0.5).orderBy("k").collect()] == [None, None, None]
    assert np.allclose(models.parameter_deviations(np.eye(3), np.zeros(3)), 0)


def test_auxiliary_definitions_are_checked():
    from firnline.operators.auxiliary import Auxiliary

    with pytest.raises(KeyError):
        Auxiliary([("sic", "no_such", {})]).validate([])
    with pytest.raises(KeyError):
        Auxiliary([("sic", "nearest", {"grid": None})]).validate([])
    with pytest.raises(KeyError):
        Auxiliary([("snow", "fixed", {"snow_depth": 1})]).validate([])
    Auxiliary([("snow", "fixed", {"snow_depth": 1})], {("snow", "fixed"): {"snow_density": 300}}).validate([])


def test_command_line_periods():
    import argparse

    from firnline import cli

    d = datetime.date
    assert cli.period("2020-02") == (d(2020, 2, 1), d(2020, 2, 29)) and cli.period("2019-12-30:2020") == (d(2019, 12, 30), d(2020, 12, 31))
    assert cli.without_months(d(2020, 1, 15), d(2020, 4, 2), [2]) == [(d(2020, 1, 15), d(2020, 1, 31)), (d(2020, 3, 1), d(2020, 3, 31)), (d(2020, 4, 1), d(2020, 4, 2))]
    with pytest.raises(argparse.ArgumentTypeError):
        cli.period("2020-13")


def test_masks_on_cells(spark):
    g = Grid("g", xsize=2_000_000.0, ysize=2_000_000.0, dx=500_000.0, dy=500_000.0)
    points = spark.createDataFrame([(0.0, 88.0, 1), (0.5, 87.9, 0), (90.0, 86.0, 1), (10.0, 20.0, 1)], "longitude double, latitude double, value int")
    near = grid.resample_mask(points, g)
    assert near.count() == 2 and {r["value"] for r in near.collect()} <= {0, 1}
    share = {(r["yj"], r["xi"]): r["value"] for r in grid.resample_mask(points, g, "mean").collect()}
    assert sorted(share.values()) == [0.5, 1.0]
    out = grid.load_masks(near.withColumnRenamed("value", "v"), {"area": near.limit(1)}).collect()
    assert sorted(str(r["area"]) for r in out)[-1] == "None"
    land = grid.land_mask(near, near.select("yj", "xi", (F.col("value") * 1.0).alias("density_of_ocean")))
    assert {(r["value"], r["is_land"]) for r in land.collect()} <= {(0, True), (1, False)}


def test_marginal_zone_flag_step(spark):
    from firnline.plans.steps import Pipeline

    rows = [("a", i, 5.0 if i < 20 else 60.0 + i, 4.0 if i < 20 else 1.0, 0.1, 0.5 if i < 24 else 0.2, 10.0 * i, 10.0 * abs(i - 20), 100.0) for i in range(60)]
    df = spark.createDataFrame(rows, "segment_id string, record_idx int, sea_ice_concentration double, leading_edge_width_rolling_mean double, peakiness_rolling_sdev double, radar_freeboard double, distance_to_low_ice_concentration double, distance_to_ocean double, spacing double")
    options = {"proximity": {"max_distance": 300.0, "sic_max": 90.0, "width_min": 0.5, "sdev_max": 1.0}, "transition": {"ice_width": 1000.0, "ocean_width": 500.0, "smoother_width": 1500.0, "width_min": 2.0, "gradient_min": 0.5}}
    out = Pipeline([("marginal_zone_flag", options)]).apply(df).orderBy("record_idx").collect()
    assert out[22]["flag_miz"] >= 1 and out[59]["flag_miz"] == 0 and {r["flag_miz"] for r in out} <= {0, 1, 2}


def test_concentration_options(spark):
    """Cut-over between data records, the pole hole and distances to the edges, with and without a day."""
    from firnline.functions.geodesy import Grid
    from firnline.operators.auxiliary import Auxiliary, grid_index

    grid = Grid("g", "north", 0.0, 2_000_000.0, 2_000_000.0, 100_000.0, 100_000.0)
    rows = [("s", i, lon, lat, day) for i, (lon, lat, day) in enumerate([(0.0, 89.9, "2020-01-01"), (10.0, 85.0, "2020-01-01"), (10.0, 85.0, "2021-01-01"), (100.0, 83.0, "2021-01-01")])]
    df = spark.createDataFrame(rows, "segment_id string, record_idx int, longitude double, latitude double, day string").withColumn("day", F.col("day").cast("date"))
    cells = spark.range(400).select((F.col("id") % 20).cast("int").alias("ix"), F.floor(F.col("id") / 20).cast("int").alias("iy"))
    hole = cells.filter("not (ix between 9 and 10 and iy between 9 and 10)")
    table = None
    for day, version, value in (("2020-01-01", "cdr", 40.0), ("2020-01-01", "icdr", 41.0), ("2021-01-01", "cdr", 50.0), ("2021-01-01", "icdr", 51.0)):
        part = hole.select("ix", "iy", F.lit(day).cast("date").alias("day"), F.lit(version).alias("version"), F.lit(value).alias("sea_ice_concentration"))
        table = part if table is None else table.unionByName(part)
    options = {"grid": grid, "cut_over": "2020-06-01", "pole_hole": {"latitude": 87.0, "value": 99.0}}
    out = Auxiliary([("sic", "nearest", options)]).apply(df, {"sic": table}).orderBy("record_idx").collect()
    assert [r["sea_ice_concentration"] for r in out] == [99.0, 40.0, 51.0, 51.0]
    field = cells.select("ix", "iy", F.when(F.col("ix") < 3, 0.0).when(F.col("ix") < 6, 40.0).otherwise(95.0).alias("sea_ice_concentration"))
    out = Auxiliary([("sic", "nearest", {"grid": grid}), ("sic", "distances", {"grid": grid, "reach": 4})]).apply(df, {"sic": field}).select("*", grid_index(grid, F.col("longitude"), F.col("latitude"))[0].alias("x")).collect()
    for r in out:
        assert abs(r["distance_to_ocean"] - max(r["x"] - 2, 0) * 1e5) < 1e-3 and abs(r["distance_to_low_ice_concentration"] - max(r["x"] - 5, 0) * 1e5) < 1e-3


def test_box_mean_by_loops(spark):
    """All widths against segments shorter and longer than them, with gaps."""
    import random

    from firnline.operators.windows import Track, box_smooth

    rng = random.Random(6)
    rows = [(n, i, None if rng.random() < 0.2 else rng.uniform(1000, 1010)) for n in (1, 2, 3, 7, 20, 61) for i in range(n)]
    df = spark.createDataFrame(rows, "segment_id int, record_idx int, v double")
    for window in (1, 3, 5, 11, 41, 201):
        got = {(r[0], r[1]): r["out"] for r in box_smooth(df, Track(), "v", window, "out").collect()}
        for n, i, _ in rows:
            reach = min(i, n - 1 - i, (window - 1) // 2)
            near = [v for m, j, v in rows if m == n and abs(j - i) <= reach and v is not None]
            want = sum(near) / len(near) if near else None
            assert (got[n, i] is None) == (want is None) and (want is None or abs(got[n, i] - want) < 1e-8), (n, i, window)
