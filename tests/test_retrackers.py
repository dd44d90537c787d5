"""Fitted retrackers, the trailing edge, ice edges and smoothers against plain loops written from their definitions."""

import math
import os

import numpy as np
import pandas as pd
import pytest

from firnline.operators import retrack as T
from firnline.operators import sealevel as S
from firnline.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
with_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def lead_value(t, t0, k, sigma, alpha):
    """One value of the lead model: the cubic is found from its four conditions by elimination."""
    d, tb = t - t0, k * sigma**2
    if d <= 0:
        f = d / sigma
    elif d >= tb:
        f = math.sqrt(k * d)
    else:
        root = math.sqrt(k * tb)
        # c1 d + c2 d^2 + c3 d^3: slope 1/sigma at 0, value root and slope k / (2 root) at tb
        c1, value, slope = 1 / sigma, root, k / (2 * root)
        c2, c3 = np.linalg.solve([[tb**2, tb**3], [2 * tb, 3 * tb**2]], [value - c1 * tb, slope - c1])
        f = c1 * d + c2 * d**2 + c3 * d**3
    return alpha * math.exp(-f * f)


def test_lead_model():
    t = np.arange(0, 40, 0.37)
    for p in ((12.3, 0.8, 1.7, 5.0), (5.0, 2.0, 0.6, 1.0), (20.0, 0.1, 3.0, 0.2)):
        got = T.lead_model(t[None, :], np.array([p]))[0]
        assert np.allclose(got, [lead_value(x, *p) for x in t], rtol=1e-9, atol=1e-12)


def test_leads_are_recovered():
    t, truth = np.arange(60.0), [(20.3, 0.8, 1.7, 5.0), (31.7, 1.5, 1.1, 900.0), (25.0, 0.6, 2.2, 0.01)]
    w = np.array([[lead_value(x, *p) for x in t] for p in truth])
    got = T.fit_leads(w)
    for i, (t0, k, sigma, alpha) in enumerate(truth):
        assert abs(got["retracked_bin"][i] - t0) < 1e-3 and abs(got["k"][i] / k - 1) < 1e-2 and abs(got["sigma"][i] / sigma - 1) < 1e-2 and abs(got["alpha"][i] / alpha - 1) < 1e-3
        point = int(got["retracked_bin"][i])
        model = [lead_value(x, got["retracked_bin"][i], got["k"][i], got["sigma"][i], got["alpha"][i]) for x in t]
        rms = math.sqrt(sum((w[i, j] - model[j]) ** 2 for j in range(point - 4, point + 1)) / 5) / got["alpha"][i]
        assert abs(got["rms"][i] - rms) < 1e-9 and abs(got["tail"][i] - sum(w[i, point + 3 :]) / got["alpha"][i]) < 1e-9
        assert got["maximum_power_bin"][i] == int(np.argmax(w[i]))


def test_skipped_bins_and_bounds(spark):
    t = np.arange(60.0)
    w = [lead_value(x, 20.3, 0.8, 1.7, 5.0) for x in t]
    noisy = [50.0, 40.0, *w[2:]]
    rows = [(0, w, t.tolist(), 5.0), (1, noisy, t.tolist(), 5.0), (2, w, t.tolist(), 0.5), (3, None, t.tolist(), 5.0), (4, [0.0] * 60, t.tolist(), 5.0), (5, [1.0, None] * 30, t.tolist(), 5.0), (6, [1.0], [1.0], 5.0)]
    df = spark.createDataFrame(rows, "i int, w array<double>, r array<double>, s double")
    plain = T.lead_retracker(T.LeadFilter(sigma0_least=1.0))
    skips = T.lead_retracker(T.LeadFilter(sigma0_least=1.0), skip=2)
    out = {r["i"]: r for r in df.select("i", plain("w", "r", "s").alias("a"), skips("w", "r", "s").alias("b")).collect()}
    assert abs(out[0]["a"]["range"] - 20.3) < 1e-2 and out[0]["a"]["ok"] and not out[2]["a"]["ok"]
    assert abs(out[1]["b"]["range"] - 20.3) < 1e-2 and out[1]["b"]["ok"]
    for i in (3, 4, 5, 6):
        assert out[i]["a"]["range"] is None and not out[i]["a"]["ok"]


def envelope_by_loops(y, start, noise, passes):
    top = max(y[start:])
    tail = [v / top for v in y[start:]]
    rows = [0] + [i for i in range(1, len(tail) - 1) if tail[i] < tail[i - 1] and tail[i] < tail[i + 1]] + [len(tail) - 1]
    for _ in range(passes):
        kept = [rows[0]] + [b for a, b in zip(rows, rows[1:]) if tail[b] < tail[a]]
        if kept == rows:
            break
        rows = kept
    high = set()
    for i in range(len(rows) - 1):
        for j in range(i, len(rows)):
            if tail[rows[j]] >= tail[rows[i]] + noise:
                high.add(j)
    return [start + r for j, r in enumerate(rows) if j not in high]


def test_lower_envelope():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(6, 60))
        y = np.exp(-np.arange(n) / 8) + rng.random(n) * rng.choice([0.0, 0.02, 0.3])
        y = np.round(y, int(rng.integers(1, 6))) + 0.01
        start, noise = int(rng.integers(0, n - 3)), float(rng.choice([0.005, 0.02, 0.2]))
        assert T.lower_envelope(y, start, noise).tolist() == envelope_by_loops(y.tolist(), start, noise, 5)


def test_trailing_edge():
    x = np.arange(1.0, 51)
    y = np.concatenate([np.linspace(0, 0.9, 10), x**-0.7])
    rough = y.copy()
    rough[20:40:5] += 0.2
    got = T.trailing_edge(np.stack([y * 3, rough * 3]), np.array([10, 10]), 0.2, 10, 0.005)
    scale = y[10] * 3
    assert np.allclose(got["scale"], scale) and abs(got["decay"][0] - 0.7) < 1e-6 and got["r2"][0] > 0.999 and got["mad"][0] < 0.01 * scale
    for i, w in enumerate((y * 3, rough * 3)):
        fit = [scale * k ** -got["decay"][i] + got["offset"][i] for k in range(1, 51)]
        tail, mean = w[10:].tolist(), sum(w[10:]) / 50
        assert abs(got["r2"][i] - (1 - sum((a - b) ** 2 for a, b in zip(tail, fit)) / sum((a - mean) ** 2 for a in tail))) < 1e-9
        assert abs(got["mad"][i] - np.median([abs(a - b) for a, b in zip(tail, fit)])) < 1e-9
        assert abs(got["quality"][i] - sum(max(a - b, 0) for a, b in zip(tail, tail[1:])) / scale) < 1e-9
        assert abs(got["power_ratio"][i] - sum(a - b for a, b in zip(tail, fit) if a > b + 0.005 * scale) / sum(w)) < 1e-9
        fine = [round(10 + k * 49 / 500, 1) for k in range(501)]
        want = next((p - 10 for p in fine if np.interp(p, range(10, 60), fit) <= 0.2 * scale), None)
        assert (np.isnan(got["width"][i]) and want is None) or abs(got["width"][i] - want) < 1e-9


def test_envelope_fit_is_the_best():
    """No pair of parameters near the fitted one does better on the envelope."""
    rng = np.random.default_rng(5)
    y = np.concatenate([np.linspace(0, 0.9, 8), np.arange(1.0, 41) ** -0.9]) + rng.random(48) * 0.05
    start = 8
    got = T.trailing_edge(y[None, :], np.array([start]))
    rows = T.lower_envelope(y, start, 0.005)
    cost = lambda d, o: sum((y[r] - (y[start] * (r - start + 1.0) ** -d + o)) ** 2 for r in rows)
    d, o = got["decay"][0], got["offset"][0]
    assert all(cost(d, o) <= cost(d + a, o + b) + 1e-12 for a in (-0.01, 0, 0.01) for b in (-0.005, 0, 0.005))


def dense_process(y, length, noise):
    ok = np.isfinite(y)
    x = np.arange(len(y), dtype=float)
    kernel = lambda a, b: (1 + np.sqrt(3) * np.abs(a[:, None] - b) / length) * np.exp(-np.sqrt(3) * np.abs(a[:, None] - b) / length)
    mean, var = y[ok].mean(), max(y[ok].var(), 1e-12)
    return mean + var * kernel(x, x[ok]) @ np.linalg.solve(var * kernel(x[ok], x[ok]) + (noise**2 + 1e-10) * np.eye(ok.sum()), y[ok] - mean)


def test_gaussian_process_is_the_dense_one():
    rng = np.random.default_rng(2)
    for n, gap in ((2, 0.0), (40, 0.0), (80, 0.5), (200, 0.1)):
        y = np.cumsum(rng.normal(size=n))
        y[rng.random(n) < gap] = np.nan
        y[0], y[-1] = 0.3, 0.1
        assert np.allclose(S.matern_mean(y, 7.0, 0.4), dense_process(y, 7.0, 0.4), atol=1e-6)
    assert np.isnan(S.matern_mean(np.array([np.nan, 1.0, np.nan]), 3.0, 0.1)).all()
    assert S.matern_mean(np.zeros(100_000), 5.0, 1.0).shape == (100_000,)


def flags_by_loops(sic, width, freeboard, distance, spacing, o):
    """Ice edges record by record."""
    n, flag = len(sic), [-1] * len(sic)
    odd = lambda m: int(m / spacing) // 2 * 2 + 1
    level = S.filtered_freeboard(np.array(freeboard), odd(o.smoother_width), o.post_window)
    grad = [math.nan] + [(b - a) * 1000 / spacing for a, b in zip(level, level[1:])]
    finite = [i for i in range(n) if math.isfinite(grad[i])]
    for e in range(1, n - 1):
        if (sic[e] > 15) == (sic[e + 1] > 15) or not all(math.isfinite(v) for v in sic[e - 1 : e + 2]):
            continue
        left = sic[e + 1] < 15
        near = [i for i in range(n) if distance[i] <= o.ice_width and math.isfinite(sic[i]) and abs(i - e) <= odd(o.ice_width)]
        sea = range(e + 1, min(e + odd(o.ocean_width), n)) if left else range(max(e - odd(o.ocean_width), 0), e + 1)
        lews = [width[i] for i in sea if math.isfinite(width[i])]
        if not any(freeboard[i] != 0 for i in near) or not any(width[i] != 0 for i in sea) or not lews or len(finite) < 2:
            continue
        steep = abs(grad[finite[-1] if left else finite[1]])
        hit = set()
        if steep >= o.gradient_least or sum(lews) / len(lews) >= o.edge_width_least:
            sign = [0 if g == 0 else math.copysign(1, g) if math.isfinite(g) else math.nan for g in grad]
            turns = [i for i in range(n - 1) if math.isfinite(grad[i]) and not sign[i + 1] == sign[i]][:-1]
            if turns:
                at = turns[-1] if left else turns[0]
                for k in range(len(turns) - 2, 0, -2) if left else range(2, len(turns), 2):
                    if not level[at] > level[turns[k]]:
                        break
                    at = turns[k]
                hit = set(range(at, e + 1) if left else range(e, at))
        for i in range(n):
            if flag[i] == -1 and (i in hit or i in near):
                flag[i] = 2 if i in hit else 1
    return flag


def test_ice_edges():
    rng = np.random.default_rng(7)
    seen = set()
    for case in range(150):
        n = int(rng.integers(20, 120))
        sic = np.where(np.cumsum(rng.random(n) < 0.03) % 2 == case % 2, 60.0, 5.0) + rng.random(n)
        sic[rng.random(n) < 0.02] = np.nan
        freeboard = np.where(sic > 15, 0.3 + 0.4 * np.exp(-np.arange(n) / 15) + rng.normal(size=n) * 0.03, np.nan)
        freeboard[rng.random(n) < 0.1] = np.nan
        width = rng.random(n) * 4
        distance = rng.random(n) * 20000
        o = S.IceEdge(15000.0, 6000.0, 5000.0, float(rng.choice([0.001, 5.0])), float(rng.choice([1.0, 9.0])), 5)
        got = S.ice_edge_flags(sic, width, freeboard, distance, 300.0, o)
        assert got.tolist() == flags_by_loops(sic.tolist(), width.tolist(), freeboard.tolist(), distance.tolist(), 300.0, o)
        seen |= set(got.tolist())
    assert seen == {-1, 1, 2}


def test_filtered_freeboard_by_loops():
    rng = np.random.default_rng(3)
    y = np.full(60, np.nan)
    y[8:50] = rng.random(42)
    y[20:23] = np.nan
    known = np.flatnonzero(np.isfinite(y))
    fit = S.lowess(y[known], 9, 3, known.astype(float))
    whole = [np.interp(i, known, fit) if known[0] <= i <= known[-1] else math.nan for i in range(60)]
    smooth = []
    for i in range(60):
        near = [whole[j] for j in range(max(i - 5, 0), min(i + 6, 60)) if math.isfinite(whole[j])]
        smooth.append(sum(near) / len(near) if near else math.nan)
    first, last = known[0] - 5, known[-1] + 5
    want = [whole[i] if first <= i < first + 11 or last - 11 <= i <= last else smooth[i] for i in range(60)]
    assert np.allclose(S.filtered_freeboard(y, 9, 11), want, equal_nan=True)


def lowess_by_loops(y, k, rounds):
    n = len(y)
    robust, fit = [1.0] * n, list(y)
    for _ in range(rounds + 1):
        new = []
        for i in range(n):
            near = sorted(range(n), key=lambda j: (abs(j - i), j))[:k]
            far = max(abs(j - i) for j in near)
            w = {j: max(0.0, 1 - (abs(j - i) / far) ** 3) ** 3 * robust[j] for j in near}
            s = max(sum(w.values()), 1e-12)
            mx, my = sum(w[j] * j for j in near) / s, sum(w[j] * y[j] for j in near) / s
            sxx = sum(w[j] * (j - mx) ** 2 for j in near)
            slope = sum(w[j] * (j - mx) * (y[j] - my) for j in near) / sxx if sxx > 1e-9 else 0.0
            new.append(my + slope * (i - mx))
        fit = new
        res = [abs(a - b) for a, b in zip(y, fit)]
        scale = 6 * float(np.median(res))
        if scale <= 1e-12:
            break
        robust = [max(0.0, 1 - (r / scale) ** 2) ** 2 for r in res]
    return fit


def test_lowess_by_loops():
    rng = np.random.default_rng(4)
    for n, k in ((10, 5), (30, 7), (25, 11)):
        y = rng.normal(size=n)
        y[n // 2] += 20
        assert np.allclose(S.lowess(y, k, 2), lowess_by_loops(y.tolist(), k, 2), atol=1e-8)


def _track(spark, columns):
    frame = spark.read.parquet(f"{DATA}/events.parquet").select("user_id", "ts", "event_id", *columns).toPandas().sort_values(["user_id", "ts", "event_id"])
    return {u: part.reset_index(drop=True) for u, part in frame.groupby("user_id")}


@with_data
def test_registered_smoothers_equal_plain_ones(spark):
    tracks = _track(spark, ["value"])
    for name, column, force in (
        ("local_regression", "value_lowess", lambda y: lowess_by_loops(y.tolist(), min(max(11, 2), len(y)), 3) if len(y) >= 3 else y),
        ("gaussian_process", "value_gp", lambda y: dense_process(y, 5.0, 10.0) if len(y) >= 2 else np.full(len(y), np.nan)),
    ):
        got = catalogue.QUERIES[name](spark, DATA).toPandas().set_index("event_id")[column]
        for part in tracks.values():
            assert np.allclose(got.loc[part["event_id"]].to_numpy(float), np.asarray(force(part["value"].to_numpy(float)), float), atol=1e-5, equal_nan=True), name


@with_data
def test_registered_deviation_filter_equals_a_plain_one(spark):
    got = catalogue.QUERIES["deviation_filter"](spark, DATA).toPandas().set_index("event_id")["kept"]
    for part in _track(spark, ["value"]).values():
        y = part["value"].to_numpy(float)
        fit = lowess_by_loops(y.tolist(), min(11, len(y)), 3) if len(y) >= 3 else y
        res = y - np.asarray(fit)
        for i in range(len(y)):
            near = res[max(i - 5, 0) : i + 6]
            sd = max(near.std(ddof=1), 1.0) if len(near) > 1 else 1.0
            want = res[i] < 2.0 * sd and res[i] > -3.0 * sd
            margin = min(abs(res[i] - 2.0 * sd), abs(res[i] + 3.0 * sd))
            assert bool(got.loc[part["event_id"][i]]) == want or margin < 1e-6


@with_data
def test_registered_transition_zone_equals_a_plain_one(spark):
    got = catalogue.QUERIES["transition_zone"](spark, DATA).toPandas().set_index("event_id")["flag_miz"]
    o = S.IceEdge(1200.0, 1500.0, 2000.0, 0.2, 3.0)
    for part in _track(spark, ["value"]).values():
        v, ids = part["value"], part["event_id"]
        want = flags_by_loops(v.tolist(), ((v - 30).abs() / 10).tolist(), (v / 100).tolist(), (ids % 5 * 400.0).tolist(), 300.0, o) if len(v) >= 3 else [-1] * len(v)
        assert got.loc[ids].tolist() == [max(x, 0) for x in want]


def retrack_by_loops(w, r, threshold, smoothing, need, bias, noise=(0, 5), factor=10):
    """The first-maximum threshold retracker, a point at a time. (range, fine index of the first maximum)."""
    n = len(w) * factor
    at = [k * (len(w) - 1) / (n - 1) for k in range(n)]
    fine = [w[min(int(x), len(w) - 2)] * (1 - (x - min(int(x), len(w) - 2))) + w[min(int(x), len(w) - 2) + 1] * (x - min(int(x), len(w) - 2)) for x in at]
    rng = [r[min(int(x), len(r) - 2)] * (1 - (x - min(int(x), len(r) - 2))) + r[min(int(x), len(r) - 2) + 1] * (x - min(int(x), len(r) - 2)) for x in at]
    half = smoothing // 2
    smooth = [sum(fine[max(i - half, 0) : min(i + smoothing - half, n)]) / smoothing for i in range(n)]
    top = max(smooth)
    y = [v / top for v in smooth]
    level = need + sum(y[noise[0] * factor : noise[1] * factor]) / ((noise[1] - noise[0]) * factor)
    peak = int(np.argmax(y))
    first = next((i for i in range(peak + 1) if y[i] >= level and (i == 0 or y[i] > y[i - 1]) and (i == peak or y[i] > y[i + 1])), peak)
    goal = threshold * y[first]
    hit = next((i for i in range(max(noise[1] * factor, 1), first) if y[i] > goal), None)
    if hit is None:
        return None, first
    part = (goal - y[hit - 1]) / (y[hit] - y[hit - 1])
    return rng[hit - 1] + part * (rng[hit] - rng[hit - 1]) - bias, first


@with_data
def test_registered_retrackers_equal_a_plain_one(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas().set_index("vec_id")["embedding"]
    step = 299792458.0 / (4 * 3.2e8)
    r = [0.0048 * 149896229.0 - 32 * step + i * step for i in range(64)]
    got = catalogue.QUERIES["first_maximum_retracker"](spark, DATA).toPandas().set_index("vec_id")
    sweep = catalogue.QUERIES["threshold_sweep"](spark, DATA).toPandas().set_index(["vec_id", "k"])["range"]
    near = lambda a, b: (b is None and pd.isna(a)) or (b is not None and not pd.isna(a) and abs(a - b) < 1.1e-5)
    for vec_id, v in e.items():
        w, m = np.abs(np.asarray(v, float)).tolist(), vec_id % 3
        options = ((11, 11, 51)[m], (0.15, 0.15, 0.45)[m], (0.0, -0.022, 0.047)[m])
        rng, first = retrack_by_loops(w, r, 0.5, *options)
        assert near(got.loc[vec_id, "range"], rng) and got.loc[vec_id, "first_maximum_index"] == first // 10
        for k, t in enumerate((0.3, 0.5, 0.7)):
            assert near(sweep.loc[(vec_id, k)], retrack_by_loops(w, r, t, *options)[0])


@with_data
def test_registered_fits_equal_single_ones(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas().set_index("vec_id")["embedding"]
    got = catalogue.QUERIES["trailing_edge_fit"](spark, DATA).toPandas().set_index("vec_id")
    leads = catalogue.QUERIES["lead_fit"](spark, DATA).toPandas().set_index("vec_id")
    for vec_id, v in list(e.items())[::7]:
        w, start = np.abs(np.asarray(v, float)), int(got.loc[vec_id, "at"])
        if 0 <= start <= 60:
            one = T.trailing_edge(w[None, :], np.array([start]))
            rows = envelope_by_loops(w.tolist(), start, 0.005, 5)
            cost = lambda d, o: sum((w[r] - (w[start] * (r - start + 1.0) ** -d + o)) ** 2 for r in rows)
            d, o = got.loc[vec_id, "decay"], got.loc[vec_id, "offset"]
            assert abs(d - one["decay"][0]) < 1e-6 and all(cost(d, o) <= cost(min(max(d + a, 0), 5), o + b) + 1e-9 for a in (-0.01, 0, 0.01) for b in (-0.005, 0, 0.005))
        model = np.array([lead_value(x, *[leads.loc[vec_id, c] for c in ("retracked_bin", "k", "sigma", "alpha")]) for x in range(64)])
        assert ((w - model) ** 2).sum() <= (w**2).sum() + 1e-9
