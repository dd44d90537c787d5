"""The whole chain from waveforms to a grid, as one declared pipeline."""

import datetime
import math

from pyspark.sql import functions as F

from firnline.functions.geodesy import Grid
from firnline.functions.physics import SPEED_OF_LIGHT
from firnline.operators.windows import Track
from firnline.plans.products import GriddedProduct
from firnline.plans.steps import Pipeline

STEP = SPEED_OF_LIGHT / 1.28e9


def echo(top, width, tail):
    """A rise to a peak at bin `top`, then an exponential tail."""
    return [0.001 + (math.exp(-((i - top) ** 2) / width) if i <= top else math.exp(-(i - top) / tail)) for i in range(64)]


def records(spark, n=60):
    rows = []
    for i in range(n):
        lead = i % 6 == 0
        height = 0.0 if lead else 0.3
        surface_range = 700000.0 - height
        power = echo(32, 1.5 if lead else 8.0, 1.0 if lead else 12.0)
        first = surface_range - 31.0 * STEP
        rows.append((
            "s1", i, datetime.datetime(2020, 3, 1, 0, 0, i % 60), -100.0 + i * 0.01, 75.0 + i * 0.003, 700000.0, 1, True, power, [first + k * STEP for k in range(64)],
            30.0 if lead else 10.0, 3, 0.0, None if i in (10, 11) else 0.05, 0.25, 0.05, 300.0, 30.0, 0.5, 95.0,
        ))
    return spark.createDataFrame(rows, (
        "segment_id string, record_idx int, time timestamp, longitude double, latitude double, altitude double, radar_mode int, is_valid boolean, waveform_power array<double>, "
        "waveform_range array<double>, peakiness double, month int, mean_sea_surface double, wet double, snow_depth double, snow_depth_uncertainty double, snow_density double, "
        "snow_density_uncertainty double, sea_ice_type double, sea_ice_concentration double"
    ))


STEPS = [
    {"step": "rolling_statistics", "options": {"columns": ["peakiness"], "window": 5}},
    {"step": "surface_type", "options": {"rules": [
        {"surface_type": "lead", "radar_mode": 1, "conditions": ["{peakiness} >= [20,20,20,20,20,20,20,20,20,20,20,20]"]},
        {"surface_type": "sea_ice", "radar_mode": 1, "conditions": ["{peakiness} < 20", "{sea_ice_concentration} > 70"]},
    ]}},
    {"step": "retrack", "options": {"surface_types": {"lead": {"smoothing": (3, 3, 3), "uncertainty": 0.1}, "sea_ice": {"smoothing": (3, 3, 3), "uncertainty": 0.1}}}},
    {"step": "range_corrections", "options": {"corrections": ["wet"]}},
    {"step": "sea_level", "options": {"filter_window": 5, "u_dist": 20.0}},
    {"step": "radar_freeboard"}, {"step": "snow_correction"},
    {"step": "valid_range", "options": {"source": "radar_freeboard", "min": -0.25, "max": 2.25, "targets": ["radar_freeboard", "sea_ice_freeboard"]}},
    {"step": "ice_density"}, {"step": "thickness"},
    {"step": "valid_range", "options": {"source": "sea_ice_thickness", "min": -0.5, "max": 10.5, "targets": ["sea_ice_thickness"]}}, {"step": "draft"},
]


def test_records_to_grid(spark):
    track = Track()
    out = Pipeline.from_config({"procsteps": STEPS}, track).apply(records(spark)).cache()
    rows = out.orderBy("record_idx").collect()
    leads, ice = [r for r in rows if r["surface_type"] == 2], [r for r in rows if r["surface_type"] == 4]
    assert len(leads) == 10 and len(ice) == 50
    assert all(r["total_range_correction"] is not None and abs(r["total_range_correction"] - 0.05) < 1e-9 for r in rows)
    assert all(r["radar_freeboard"] is None for r in leads)
    freeboards = [r["radar_freeboard"] for r in ice]
    assert max(freeboards) - min(freeboards) < 0.05  # one height everywhere
    r = ice[5]
    assert abs(r["sea_ice_draft"] - (r["sea_ice_thickness"] - r["sea_ice_freeboard"])) < 1e-9
    assert all(x["sea_level_anomaly_uncertainty"] >= 0.02 for x in rows)
    product = GriddedProduct(
        Grid("nh"), {"sea_ice_thickness": "average", "latitude": "average", "sea_ice_concentration": "average", "peakiness": "median"}, 2,
        prefilter="sea_ice_thickness", classifier_parameters=("peakiness",), period_days=31,
    )
    cells = product.cells(out, track, "2020-03-01").collect()
    assert sum(c["n_total_waveforms"] for c in cells) == 60
    thick = [r["sea_ice_thickness"] for r in ice if r["sea_ice_thickness"] is not None]
    means = [c["sea_ice_thickness"] for c in cells if c["sea_ice_thickness"] is not None]
    assert means and min(thick) - 1e-9 <= min(means) and max(means) <= max(thick) + 1e-9
    assert {c["status_flag"] for c in cells} <= {4, 5}


def test_one_plan_sorts_segments_once_per_layout(spark):
    """All window steps of a segment share the exchange by segment."""
    df = records(spark, 10).repartition(3)
    steps = [s for s in STEPS if s["step"] in ("rolling_statistics",)] + [{"step": "range_corrections", "options": {"corrections": ["wet"], "target": "altitude"}}]
    plan = Pipeline.from_config({"procsteps": steps}).apply(df.withColumn("elevation", F.lit(0.0)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(segment_id") == 1
