import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from firnline.functions import geodesy as Y
from firnline.functions import physics as P
from firnline.functions import predicates as Q
from firnline.functions import vocab as V
from firnline.functions import waveform as W
from firnline.operators import lookups as L
from firnline.operators import retrack as T
from firnline.operators import sealevel as S
from firnline.plans.steps import Pipeline, PipelineError
from firnline.sources.manifest import closest_dates
from firnline.sources.sinks import fill_template


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_predicates_reject_code(spark):
    for bad in ("__import__('os')", "{x} >= 1 or True", "{x} >= open('f')", "{x} ** 2 > 1"):
        with pytest.raises(Q.PredicateError):
            Q.compile_clause(bad)
    with pytest.raises(Q.PredicateError):
        Q.compile_clause("{x} >= [1, 2]", F.lit(1))


def test_predicate_on_null_is_false(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "x double")
    assert [r[0] for r in df.select(Q.compile_clause("{x} >= 1")).collect()] == [False, True]


def test_error_bits_do_not_carry(spark):
    flag = V.raise_bit(V.raise_bit(F.lit(0), 9, F.lit(True)), 9, F.lit(True))
    assert one(spark, f=flag)["f"] == 512


def test_nan_becomes_null_and_back(spark):
    df = spark.createDataFrame([(1.0, [1.0, float("nan")]), (float("nan"), None)], "x double, w array<double>")
    out = V.missing_to_null(df).collect()
    assert out[1]["x"] is None and out[0]["w"] == [1.0, None]
    assert math.isnan(V.null_to_missing(V.missing_to_null(df)).collect()[1]["x"])


def test_projection_reference_points(spark):
    x0, y0 = Y.laea_polar(F.lit(0.0), F.lit(90.0))
    x1, y1 = Y.laea_polar(F.lit(90.0), F.lit(0.0))
    r = one(spark, x0=x0, y0=y0, x1=x1, y1=y1)
    assert abs(r["x0"]) < 1e-6 and abs(r["y0"]) < 1e-6
    assert abs(r["x1"] - 9009964.76) < 0.01 and abs(r["y1"]) < 1e-3


def test_cells_outside_the_grid_are_null(spark):
    g = Y.Grid("g", xsize=100.0, ysize=100.0, dx=10.0, dy=10.0)
    xi, yj = Y.cell_index(F.lit(-50.1), F.lit(49.9), g)
    r = one(spark, xi=xi, yj=yj)
    assert r["xi"] is None and r["yj"] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(0.01, 10), min_size=16, max_size=40))
def test_first_maximum_matches_a_loop(values):
    w = np.array([values])
    o = T.FirstMaximum(oversampling=1, smoothing=(1, 1, 1), noise_bins=(0, 1))
    p = T.prepare(np.arange(len(values), dtype=float)[None], w, np.array([0]), np.array([True]), o)
    y = p.power[0]
    need, top = 0.15 + y[0], int(y.argmax())
    padded = np.concatenate([[-1e-6], y[: top + 1], [-1e-6]])
    peaks = [i for i in range(top + 1) if padded[i + 1] > padded[i] and padded[i + 1] > padded[i + 2] and y[i] >= need]
    assert p.fmi[0] == (peaks[0] if peaks else top)


def test_retracker_finds_half_power_of_a_ramp(spark):
    power = [0.0] * 20 + [i / 10 for i in range(11)] + [0.8, 0.5, 0.3] + [0.1] * 30
    df = spark.createDataFrame([(power, [float(i) for i in range(64)], 0, True), (None, None, 0, True), ([0.0] * 64, [float(i) for i in range(64)], 1, True)], "w array<double>, r array<double>, m int, v boolean")
    udf = T.first_maximum_retracker(T.FirstMaximum(smoothing=(1, 1, 1)))
    rows = df.select(udf("w", "r", "m", "v", F.lit(0.5)).alias("t")).select("t.*").collect()
    assert abs(rows[0]["range"] - 25) < 0.2
    assert rows[1]["range"] is None and rows[2]["range"] is None


def test_least_squares_recovers_a_line():
    x = np.arange(10.0)
    y = np.stack([3 * x - 2, -x + 5])
    p, res = T.least_squares(lambda q, _: q[:, :1] * x + q[:, 1:], y, np.zeros((2, 2)))
    assert np.allclose(p, [[3, -2], [-1, 5]], atol=1e-6) and np.abs(res).max() < 1e-6


def test_lowess_keeps_lines_and_resists_outliers():
    x = np.arange(50.0)
    y = 2 * x + 1
    assert np.allclose(S.lowess(y, 11), y, atol=1e-8)
    y2 = y + np.random.default_rng(0).normal(0, 0.1, 50)
    y2[25] += 100
    assert abs(S.lowess(y2, 15)[24] - y[24]) < 2


def test_inside_ring():
    ring = np.array([(0, 0), (4, 0), (4, 4), (0, 4)], float)
    assert L.inside_ring(np.array([1.0, 5.0]), np.array([1.0, 1.0]), ring).tolist() == [True, False]
    assert np.allclose(L.ring_distance(np.array([6.0]), np.array([2.0]), ring), [2.0])


def test_snow_and_thickness_values(spark):
    c = P.ice_freeboard_to_thickness(F.lit(0.2), F.lit(0.3), F.lit(1024.0), F.lit(916.7), F.lit(320.0))
    assert abs(one(spark, v=c)["v"] - (1024 * 0.2 + 320 * 0.3) / (1024 - 916.7)) < 1e-12


def test_waveform_padding(spark):
    r = one(spark, p=W.pad_power(F.array(F.lit(1.0), F.lit(2.0)), 4), r=W.pad_range(F.array(F.lit(1.0), F.lit(1.5)), 4), s=W.reduce_bins(F.array(F.lit(1.0), F.lit(2.0)), 4))
    assert r["p"] == [1.0, 2.0, 0.0, 0.0] and r["r"] == [1.0, 1.5, 2.0, 2.5] and r["s"] == [1.0, 2.0]


def test_pipeline_rejects_bad_definitions(spark):
    with pytest.raises(PipelineError):
        Pipeline([("no_such_step", {})]).validate([])
    with pytest.raises(PipelineError):
        Pipeline([("radar_freeboard", {})]).validate(["elevation"])
    with pytest.raises(PipelineError):
        Pipeline([("valid_range", {"source": "x"})]).validate(["x"])
    with pytest.raises(PipelineError):
        Pipeline.from_config({})


def test_templates():
    import datetime

    out = fill_template("{mission:upper}-{start:%Y%m%d}-{kind:lower;[:3]}.nc", {"mission": "cs2", "start": datetime.date(2020, 1, 2), "kind": "CDR9"})
    assert out == "CS2-20200102-cdr.nc"
    with pytest.raises(KeyError):
        fill_template("{nope}", {})
    assert closest_dates([2]) == [0, -1, 1, -2, 2]


def test_spline_passes_through_its_values():
    from firnline.operators.lookups import spline_line

    rng = np.random.default_rng(0)
    for n in (2, 3, 7, 60):
        v = rng.normal(size=n)
        c = spline_line(v)
        mirrored = np.concatenate([[c[1]], c, [c[-2]]])
        assert np.allclose((mirrored[:-2] + 4 * mirrored[1:-1] + mirrored[2:]) / 6, v, atol=1e-10)
    assert spline_line(np.array([3.0])).tolist() == [3.0]
