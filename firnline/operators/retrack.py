"""Retrackers as Arrow-batched operators on waveform matrices: the threshold first-maximum retracker family and its
derived widths, centre-of-gravity, parametric lead and trailing-edge fits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FirstMaximum:
    """Options of the threshold first-maximum retracker; triples are per radar mode (lrm, sar, sin)."""

    threshold: float = 0.5
    offset: float = 0.0
    noise_bins: tuple[int, int] = (0, 5)
    oversampling: int = 10
    smoothing: tuple[int, int, int] = (11, 11, 51)
    first_maximum_threshold: tuple[float, float, float] = (0.15, 0.15, 0.45)
    ignore_leading_bins: int = 0
    range_bias: tuple[float, float, float] = (0.0, 0.0, 0.0)
    uncertainty: float = 0.0


@dataclass
class Prepared:
    rng: np.ndarray
    power: np.ndarray  # oversampled, smoothed, peak 1
    fmi: np.ndarray  # -1: none
    norm: np.ndarray
    options: FirstMaximum = field(repr=False)


def oversample(matrix: np.ndarray, factor: int) -> np.ndarray:
    """n bins to n * factor equidistant points from the first to the last bin, linearly."""
    n = matrix.shape[1]
    x = np.linspace(0, n - 1, n * factor)
    i = np.minimum(x.astype(np.int64), n - 2)
    part = x - i
    return matrix[:, i] * (1 - part) + matrix[:, i + 1] * part


def box(matrix: np.ndarray, window: int) -> np.ndarray:
    """Centred moving mean, zeros beyond the ends."""
    half = window // 2
    total = np.cumsum(np.pad(matrix, ((0, 0), (half + 1, window - 1 - half))), axis=1)
    return (total[:, window:] - total[:, : -window]) / window


def prepare(rng: np.ndarray, power: np.ndarray, mode: np.ndarray, valid: np.ndarray, o: FirstMaximum) -> Prepared:
    """All rows of a batch at once; rows that are not valid or without power have no first maximum."""
    fine_rng = oversample(rng, o.oversampling)
    fine = oversample(power, o.oversampling)
    for m in np.unique(mode):
        rows = mode == m
        fine[rows] = box(fine[rows], o.smoothing[m])
    norm = fine.max(axis=1, initial=-np.inf)
    ok = valid & np.isfinite(norm) & (norm > 0)
    fine = fine / np.where(ok, norm, 1.0)[:, None]
    first, last = (b * o.oversampling for b in o.noise_bins)
    noise = fine[:, first:last].mean(axis=1)
    need = np.asarray(o.first_maximum_threshold)[mode] + noise
    skip = o.ignore_leading_bins * o.oversampling
    top = fine.argmax(axis=1)
    n = fine.shape[1]
    at = np.arange(n)
    before = np.concatenate([np.full((len(fine), 1), -1e-6), fine[:, :-1]], axis=1)
    after = np.concatenate([fine[:, 1:], np.full((len(fine), 1), -1e-6)], axis=1)
    before[:, skip] = -1e-6
    after = np.where(at[None, :] == top[:, None], -1e-6, after)
    peaks = (fine > before) & (fine > after) & (fine >= need[:, None]) & (at >= skip) & (at[None, :] <= top[:, None])
    fmi = np.where(peaks.any(axis=1), peaks.argmax(axis=1), top)
    return Prepared(fine_rng, fine, np.where(ok, fmi, -1), norm, o)


def threshold_range(p: Prepared, threshold: np.ndarray, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(range, power) where the power first exceeds threshold * first maximum between `first` and the first maximum."""
    rows, at = np.arange(len(p.fmi)), np.arange(p.power.shape[1])
    level = threshold * p.power[rows, np.maximum(p.fmi, 0)]
    above = (p.power > level[:, None]) & (at >= max(first, 1)) & (at[None, :] < p.fmi[:, None])
    found = above.any(axis=1) & (p.fmi >= 0) & np.isfinite(level)
    i1 = np.where(found, above.argmax(axis=1), 1)
    i0 = i1 - 1
    with np.errstate(divide="ignore", invalid="ignore"):
        part = (level - p.power[rows, i0]) / (p.power[rows, i1] - p.power[rows, i0])
    rng = p.rng[rows, i0] + part * (p.rng[rows, i1] - p.rng[rows, i0])
    return np.where(found, rng, np.nan), np.where(found, level, np.nan)


def edge_width(p: Prepared, low: float, high: float) -> np.ndarray:
    """Range between two thresholds; negative widths are missing."""
    first = p.options.noise_bins[1] * p.options.oversampling
    n = len(p.fmi)
    width = threshold_range(p, np.full(n, high), first)[0] - threshold_range(p, np.full(n, low), first)[0]
    return np.where(width < 0, np.nan, width)


def threshold_column(rule: float | Mapping) -> Column:
    """The retracker's threshold before the batch operator: fixed, a polynomial of sigma0, one of two by ice type, a plane
    of edge width and sigma0, or a column."""
    if isinstance(rule, (int, float)):
        return F.lit(float(rule))
    power = lambda name, coefficients, first: sum((F.lit(float(c)) * F.pow(F.col(name), F.lit(float(i + first))) for i, c in enumerate(coefficients)), F.lit(0.0))
    kind = rule["type"]
    if kind == "fixed":
        return F.lit(float(rule["value"]))
    if kind == "sigma_func":
        return power("sigma0", rule["coef"], 0)
    if kind == "sitype_sigma_func":
        return F.when(F.col("sea_ice_type") > 0.5, power("sigma0", rule["coef_myi"], 0)).otherwise(power("sigma0", rule["coef_fyi"], 0))
    if kind == "poly_plane_fit":
        return F.lit(float(rule["intercept"])) + power("leading_edge_width", rule["coef_lew"], 1) + power("sigma0", rule["coef_sig0"], 1)
    if kind == "l2_variable":
        return F.col(rule["variable_name"])
    raise ValueError(f"unknown threshold type {kind!r}")


def _matrix(column: pd.Series) -> np.ndarray:
    rows = [np.asarray(x, float) if x is not None else np.zeros(0) for x in column]
    width = max((len(r) for r in rows), default=0)
    out = np.full((len(rows), max(width, 2)), np.nan)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _usable(power: np.ndarray, valid: np.ndarray) -> np.ndarray:
    return valid & np.isfinite(power).all(axis=1)


_STRUCT = "struct<range:double,power:double,uncertainty:double,first_maximum_index:int,leading_edge_width:double>"


def first_maximum_retracker(options: FirstMaximum = FirstMaximum(), widths: tuple[float, float] = (0.05, 0.95)):
    """A pandas UDF (power, range, mode, valid, threshold) -> range, power, uncertainty, index, edge width."""

    @F.pandas_udf(_STRUCT)
    def retrack(power: pd.Series, rng: pd.Series, mode: pd.Series, valid: pd.Series, threshold: pd.Series) -> pd.DataFrame:
        w, r = _matrix(power), _matrix(rng)
        m = mode.fillna(0).to_numpy(np.int64)
        ok = _usable(w, valid.fillna(False).to_numpy(bool))
        p = prepare(np.nan_to_num(r), np.nan_to_num(w), m, ok, options)
        got, level = threshold_range(p, threshold.to_numpy(float), options.noise_bins[1] * options.oversampling)
        got = got + options.offset - np.asarray(options.range_bias)[m]
        width = np.where(ok, edge_width(p, *widths), np.nan)
        none = lambda a: pd.Series(a).where(np.isfinite(a), None)
        return pd.DataFrame({
            "range": none(got), "power": none(level * p.norm), "uncertainty": np.where(np.isfinite(got), options.uncertainty, np.nan),
            "first_maximum_index": (p.fmi // options.oversampling).astype(np.int32), "leading_edge_width": none(width),
        })

    return retrack


def threshold_sweep(thresholds: Sequence[float], options: FirstMaximum = FirstMaximum()):
    """A pandas UDF (power, range, mode, valid) -> the retracked range at each threshold."""

    @F.pandas_udf("array<double>")
    def sweep(power: pd.Series, rng: pd.Series, mode: pd.Series, valid: pd.Series) -> pd.Series:
        w, r = _matrix(power), _matrix(rng)
        m = mode.fillna(0).to_numpy(np.int64)
        p = prepare(np.nan_to_num(r), np.nan_to_num(w), m, _usable(w, valid.fillna(False).to_numpy(bool)), options)
        bias = options.offset - np.asarray(options.range_bias)[m]
        first = options.noise_bins[1] * options.oversampling
        out = np.stack([threshold_range(p, np.full(len(w), t), first)[0] + bias for t in thresholds], axis=1)
        return pd.Series([[None if np.isnan(v) else v for v in row] for row in out])

    return sweep


def multi_threshold_freeboards(df: DataFrame, thresholds: Sequence[float], options: FirstMaximum = FirstMaximum(), out: str = "threshold_freeboards") -> DataFrame:
    """altitude - range - corrections - mss - sla + snow correction, for every threshold."""
    base = F.col("altitude") - F.col("total_range_correction") - F.col("mean_sea_surface") - F.col("sea_level_anomaly") + F.coalesce("snow_geometric_correction", F.lit(0.0))
    ranges = threshold_sweep(thresholds, options)("waveform_power", "waveform_range", "radar_mode", "is_valid")
    return df.withColumn("__r", ranges).withColumn("__b", base).withColumn(out, F.transform("__r", lambda r: F.col("__b") - r)).drop("__r", "__b")


def retrack_by_surface(df: DataFrame, retrackers: Mapping[int, Column], altitude: str = "altitude", surface: str = "surface_type", invalid: int = 8) -> DataFrame:
    """Each surface type by its own retracker (a struct column); rows it cannot retrack become invalid."""
    best = F.lit(None).cast(_STRUCT)
    for code, column in retrackers.items():
        best = F.when(F.col(surface) == code, column).otherwise(best)
    base = df.withColumn("__r", best)
    failed = F.col(surface).isin(*retrackers) & F.col("__r.range").isNull()
    return base.withColumns({
        "retracked_range": F.col("__r.range"), "elevation": F.col(altitude) - F.col("__r.range"),
        "elevation_uncertainty": F.col("__r.uncertainty"), "retracker_failed": failed,
        surface: F.when(failed, F.lit(invalid)).otherwise(F.col(surface)),
    }).drop("__r")


def least_squares(
    model, y: np.ndarray, start: np.ndarray, low=None, high=None, weight: np.ndarray | None = None, rounds: int = 80, through=lambda x, rows: x, stop: float = 1e-13,
) -> tuple[np.ndarray, np.ndarray]:
    """Levenberg-Marquardt for many series at once, with numerical Jacobians and box bounds. model: (parameters, rows) -> power
    of these rows; y: (rows, bins); weight: 0 for bins that take no part; bounds: one for all rows, or one for each; through:
    a linear map of (residuals, rows); stop: the share of the cost by which a round must lower it. Rows that are done take no further part. (parameters, residuals)."""
    p = np.array(start, float)
    n, k = p.shape
    low = np.full(k, -np.inf) if low is None else np.asarray(low, float)
    high = np.full(k, np.inf) if high is None else np.asarray(high, float)
    w = np.ones_like(y) if weight is None else weight
    bound = lambda b, rows: b if b.ndim == 1 else b[rows]
    everything, damping, live = np.arange(n), np.full(n, 1e-2), np.ones(n, bool)
    p = np.clip(p, low, high)
    with np.errstate(all="ignore"):
        res = through((y - model(p, everything)) * w, everything)
        cost = (res * res).sum(1)
        for _ in range(rounds):
            rows = np.flatnonzero(live)
            if not len(rows):
                break
            q = p[rows]
            h = 1e-6 * np.maximum(np.abs(q), 1e-3)
            slopes = [(model(q + h * (np.arange(k) == j), rows) - model(q - h * (np.arange(k) == j), rows)) / (2 * h[:, j : j + 1]) for j in range(k)]
            jac = np.nan_to_num(np.stack([through(s * w[rows], rows) for s in slopes], axis=2))
            turned = jac.transpose(0, 2, 1)
            a, g = turned @ jac, (turned @ res[rows][:, :, None])[:, :, 0]
            scale = np.einsum("rii->ri", a) + 1e-12
            waiting, moved = np.arange(len(rows)), np.zeros(len(rows), bool)
            for _ in range(12):
                if not len(waiting):
                    break
                r = rows[waiting]
                step = np.linalg.solve(a[waiting] + (damping[r][:, None] * scale[waiting])[:, :, None] * np.eye(k), g[waiting][:, :, None])[:, :, 0]
                new = np.clip(q[waiting] + step, bound(low, r), bound(high, r))
                new_res = through((y[r] - model(new, r)) * w[r], r)
                new_cost = (new_res * new_res).sum(1)
                better = np.isfinite(new_cost) & (new_cost < cost[r])
                hit = r[better]
                live[hit[cost[hit] - new_cost[better] <= stop * (cost[hit] + 1e-30)]] = False
                p[hit], res[hit], cost[hit] = new[better], new_res[better], new_cost[better]
                damping[hit] = np.maximum(damping[hit] / 10, 1e-9)
                moved[waiting[better]] = True
                waiting = waiting[~better]
                damping[rows[waiting]] *= 10
            live[rows[~moved]] = False
    return p, res


def lead_model(t: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha * exp(-F^2) for rows of parameters (epoch, k, sigma, alpha): F is a line of slope 1 / sigma up to the epoch, a
    square root of k times the delay from k sigma^2 behind it on, and a cubic with the same values and slopes between."""
    t0, k, sigma, alpha = (p[:, i : i + 1] for i in range(4))
    d, joint = t - t0, k * sigma**2
    cubic = d / sigma + d**2 / (2 * k * sigma**3) - d**3 / (2 * k**2 * sigma**5)
    f = np.where(d <= 0, d / sigma, np.where(d < joint, cubic, np.sqrt(np.maximum(k * d, 0))))
    return alpha * np.exp(-np.minimum(f * f, 700))


@dataclass(frozen=True)
class LeadFilter:
    """Bounds that a lead must keep, all strict; sigma0_least None: no bound."""

    sigma_most: float = 20.0
    peak_bin_least: float = 0.0
    sigma0_least: float | None = None
    peak_away_most: float = 10.0
    tail_most: float = 100.0
    rms_most: float = 0.3
    first_bin: float = 0.0
    last_bin: float = 1e9


def fit_leads(w: np.ndarray, skip: int = 0, k: float = 1.0, sigma: float = 1.0) -> dict[str, np.ndarray]:
    """The lead model fitted to rows of finite power, from their peak with k and sigma as first guess. rms: over the five
    bins that end at the retracked one; tail: power from three bins behind it on; both over alpha."""
    part = w[:, skip:]
    top = part.argmax(axis=1)
    scale = np.maximum(part.max(axis=1), 1e-300)
    t = np.arange(part.shape[1], dtype=float)[None, :]
    start = np.column_stack([top, np.full(len(w), k), np.full(len(w), sigma), np.ones(len(w))])
    p, _ = least_squares(lambda q, _: lead_model(t, q), part / scale[:, None], start, [-np.inf, 1e-4, 1e-4, 1e-6], stop=1e-9)
    p = p * np.column_stack([np.ones((len(w), 3)), scale])
    at = skip + p[:, 0]
    shifted = np.column_stack([at, p[:, 1:]])
    model = lead_model(np.arange(w.shape[1], dtype=float)[None, :], shifted)
    point = np.trunc(at)[:, None]
    bins = np.arange(w.shape[1])[None, :]
    near = (bins >= point - 4) & (bins <= point)
    rms = np.sqrt((np.where(near, w - model, 0.0) ** 2).sum(1) / 5) / p[:, 3]
    tail = np.where(bins >= point + 3, w, 0.0).sum(1) / p[:, 3]
    return {"retracked_bin": at, "maximum_power_bin": top.astype(float), "k": p[:, 1], "sigma": p[:, 2], "alpha": p[:, 3], "rms": rms, "tail": tail}


def lead_retracker(bounds: LeadFilter = LeadFilter(), skip: int = 0, k: float = 1.0, sigma: float = 1.0):
    """A pandas UDF (power, range, sigma0) -> range, retracked bin, peak bin, k, sigma, alpha, rms, tail and whether all
    bounds are kept. Waveforms that are missing, not finite or without power have none; range is NULL outside the window."""
    fields = ("range", "retracked_bin", "maximum_power_bin", "k", "sigma", "alpha", "rms", "tail")

    @F.pandas_udf("struct<" + ",".join(f"{f}:double" for f in fields) + ",ok:boolean>")
    def retrack(power: pd.Series, rng: pd.Series, sigma0: pd.Series) -> pd.DataFrame:
        w, r = _matrix(power), _matrix(rng)
        out = {f: np.full(len(power), np.nan) for f in fields}
        lengths = power.map(lambda x: 0 if x is None else len(x)).to_numpy()
        for n in np.unique(lengths[lengths >= skip + 8]).tolist():
            rows = np.flatnonzero((lengths == n) & np.isfinite(w[:, :n]).all(axis=1) & (w[:, skip:n].max(axis=1, initial=0) > 0))
            if not len(rows):
                continue
            got = fit_leads(w[rows, :n], skip, k, sigma)
            for f, v in got.items():
                out[f][rows] = v
            at, inside = got["retracked_bin"], (got["retracked_bin"] >= 0) & (got["retracked_bin"] <= n - 1)
            i = np.clip(np.floor(np.nan_to_num(at)), 0, n - 2).astype(int)
            if r.shape[1] >= n:
                value = r[rows, i] + (at - i) * (r[rows, i + 1] - r[rows, i])
                out["range"][rows] = np.where(inside, value, np.nan)
        ok = (out["sigma"] < bounds.sigma_most) & (out["maximum_power_bin"] > bounds.peak_bin_least) & (np.abs(out["retracked_bin"] - out["maximum_power_bin"]) < bounds.peak_away_most)
        ok &= (out["tail"] < bounds.tail_most) & (out["rms"] < bounds.rms_most) & (out["retracked_bin"] > bounds.first_bin) & (out["retracked_bin"] < bounds.last_bin)
        if bounds.sigma0_least is not None:
            ok &= sigma0.to_numpy(float) > bounds.sigma0_least
        return pd.DataFrame({f: pd.Series(v).where(np.isfinite(v), None) for f, v in out.items()} | {"ok": ok})

    return retrack


def lower_envelope(y: np.ndarray, start: int, noise: float = 0.02, passes: int = 5) -> np.ndarray:
    """Indices of the trailing edge's lower envelope: its first and last bin and the strict local minima between, without
    those that do not fall below the one before (in some passes) and without those above any earlier one by the noise level
    (in shares of the edge's highest power)."""
    tail = y[start:] / np.nanmax(y[start:])
    inner = np.flatnonzero((tail[1:-1] < tail[:-2]) & (tail[1:-1] < tail[2:])) + 1
    rows = np.concatenate([[0], inner, [len(tail) - 1]])
    for _ in range(passes):
        falls = np.concatenate([[True], np.diff(tail[rows]) < 0])
        if falls.all():
            break
        rows = rows[falls]
    if len(rows) > 1:
        lowest = np.minimum.accumulate(tail[rows[:-1]])[np.minimum(np.arange(len(rows)), len(rows) - 2)]
        rows = rows[tail[rows] < lowest + noise]
    return rows + start


_TRAILING = ("scale", "decay", "offset", "r2", "mad", "width", "quality", "power_ratio")


def trailing_edge(w: np.ndarray, start: np.ndarray, floor: float = 0.05, oversampling: int = 10, noise: float = 0.005) -> dict[str, np.ndarray]:
    """Rows of finite power of one length: scale * x^-decay + offset (scale: the power at the first maximum, x from 1 there)
    fitted to the lower envelope behind the first maximum, and over the whole trailing edge the fit's R^2, the median
    absolute deviation, the bins until the fit falls to `floor` of the scale, the share of power drops, and the power
    above fit and noise over the waveform's."""
    n, bins = w.shape
    scale = w[np.arange(n), start]
    at = np.arange(bins)[None, :]
    x = np.maximum(at - start[:, None] + 1.0, 1.0)
    mask = np.zeros((n, bins))
    for i in range(n):
        mask[i, lower_envelope(w[i], int(start[i]), noise)] = 1.0
    tail = at >= start[:, None]
    unit = np.maximum(scale, 1e-300)[:, None]
    model = lambda p, rows: x[rows] ** -p[:, :1] + p[:, 1:]
    p, _ = least_squares(model, w / unit, np.tile([0.75, 0.0], (n, 1)), [0.0, -np.inf], [5.0, np.inf], mask)
    fit = model(p, slice(None)) * unit
    size = tail.sum(1)
    mean = np.where(tail, w, 0.0).sum(1) / size
    residual = np.where(tail, w - fit, np.nan)
    total = np.where(tail, (w - mean[:, None]) ** 2, 0.0).sum(1)
    drops = np.where(tail[:, :-1], np.maximum(w[:, :-1] - w[:, 1:], 0.0), 0.0).sum(1)
    higher = tail & (w > fit + noise * scale[:, None])
    width = np.full(n, np.nan)
    for i in range(n):
        fine = np.around(np.linspace(0, size[i] - 1, size[i] * oversampling + 1) + start[i], 1)
        level = np.interp(fine, np.arange(start[i], bins), fit[i, start[i] :])
        under = np.flatnonzero(level <= floor * scale[i])
        if len(under):
            width[i] = fine[under[0]] - start[i]
    with np.errstate(all="ignore"):
        return {
            "scale": scale, "decay": p[:, 0], "offset": p[:, 1] * scale, "r2": np.where(total > 0, 1 - np.nansum(residual**2, axis=1) / total, np.nan),
            "mad": np.nanmedian(np.abs(residual), axis=1), "width": width, "quality": drops / scale,
            "power_ratio": np.where(higher, w - fit, 0.0).sum(1) / w.sum(1),
        }


def trailing_edge_fit(floor: float = 0.05, oversampling: int = 10, first: int = 0, last: int = 1 << 30):
    """A pandas UDF (power, first maximum index) -> the outputs of trailing_edge(). Waveforms whose first maximum is outside
    first .. last, with fewer than four bins behind it, or without finite power have none."""

    @F.pandas_udf("struct<" + ",".join(f"{f}:double" for f in _TRAILING) + ">")
    def fit(power: pd.Series, index: pd.Series) -> pd.DataFrame:
        w, start = _matrix(power), index.fillna(-1).to_numpy(np.int64)
        out = {f: np.full(len(power), np.nan) for f in _TRAILING}
        lengths = power.map(lambda x: 0 if x is None else len(x)).to_numpy()
        for n in np.unique(lengths[lengths > 0]).tolist():
            ok = (lengths == n) & (start >= max(first, 0)) & (start <= min(last, n - 4)) & np.isfinite(w[:, :n]).all(axis=1)
            rows = np.flatnonzero(ok)
            rows = rows[w[rows, start[rows]] > 0]
            if len(rows):
                for f, v in trailing_edge(w[rows, :n], start[rows], floor, oversampling).items():
                    out[f][rows] = v
        return pd.DataFrame({f: pd.Series(v).where(np.isfinite(v), None) for f, v in out.items()})

    return fit
