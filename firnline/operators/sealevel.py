"""Sea-level anomaly along a trajectory from tie points, and the smoothers it needs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.functions.geodesy import great_circle
from firnline.functions.physics import sea_level_uncertainty
from firnline.functions.vocab import is_surface
from firnline.operators.windows import Track, box_smooth, fill_gaps, flag_distance, odd_window


def footprint_spacing(df: DataFrame, track: Track, lon: str = "longitude", lat: str = "latitude", out: str = "spacing") -> DataFrame:
    """Metres between the segment's first two records (its last two if these coincide), NULL for a single record."""
    step = great_circle(F.col(lon), F.col(lat), F.lead(lon).over(track.along), F.lead(lat).over(track.along))
    base = df.withColumns({"__step": step, "__pos": track.position(), "__n": F.count(F.lit(1)).over(track.whole)})
    first = F.max(F.when(F.col("__pos") == 0, F.col("__step"))).over(track.whole)
    last = F.max(F.when(F.col("__pos") == F.col("__n") - 2, F.col("__step"))).over(track.whole)
    return base.withColumn(out, F.when(first > 1e-6, first).otherwise(last)).drop("__step", "__pos", "__n")


def lowess(y: np.ndarray, window: int, rounds: int = 3, x: np.ndarray | None = None) -> np.ndarray:
    """Locally weighted straight lines (tricube weights over the `window` nearest points, bisquare robustness)."""
    n = len(y)
    x = np.arange(n, dtype=float) if x is None else np.asarray(x, float)
    k = int(min(max(window, 2), n))
    if n < 3:
        return np.asarray(y, float).copy()
    start = np.clip(np.searchsorted(x, x) - k // 2, 0, n - k)
    for _ in range(k):  # slide each window to the k nearest points
        right = np.minimum(start + k, n - 1)
        move = (start + k < n) & (x - x[start] > x[right] - x)
        if not move.any():
            break
        start = start + move
    idx = start[:, None] + np.arange(k)
    d = np.abs(x[idx] - x[:, None])
    far = np.maximum(d.max(axis=1), 1e-12)
    w0 = np.clip(1 - (d / far[:, None]) ** 3, 0, None) ** 3
    robust, fit = np.ones(n), np.asarray(y, float)
    for _ in range(rounds + 1):
        w = w0 * robust[idx]
        s = np.maximum(w.sum(axis=1), 1e-12)
        dx = x[idx] - x[:, None]
        mx, my = (w * dx).sum(1) / s, (w * y[idx]).sum(1) / s
        sxx = (w * (dx - mx[:, None]) ** 2).sum(1)
        slope = np.where(sxx > 1e-9, (w * (dx - mx[:, None]) * (y[idx] - my[:, None])).sum(1) / np.maximum(sxx, 1e-9), 0.0)
        fit = my - slope * mx
        res = np.abs(y - fit)
        scale = 6 * np.median(res)
        if scale <= 1e-12:
            break
        robust = np.clip(1 - (res / scale) ** 2, 0, None) ** 2
    return fit


def _per_segment(df: DataFrame, track: Track, out: str, values):
    """values(pdf, ordered by the track) -> array, as a new column; one segment is one bounded trajectory."""
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", `{out}` double"

    order = list(track.order)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, ignore_index=True)
        v = np.asarray(values(pdf), float)
        return pdf.assign(**{out: pd.Series(v).where(np.isfinite(v), None)})

    return df.groupBy(*track.segment).applyInPandas(run, schema)


def lowess_smooth(df: DataFrame, track: Track, column: str, window: str | int, out: str | None = None, rounds: int = 3) -> DataFrame:
    """Local regression of the values present; rows without a value stay NULL. window: records, or a column of them."""

    def values(pdf: pd.DataFrame) -> np.ndarray:
        y = pdf[column].to_numpy(float)
        ok, result = np.isfinite(y), np.full(len(y), np.nan)
        size = window if isinstance(window, int) else pdf[window].iloc[0]
        if ok.sum() and size is not None and np.isfinite(float(size)):
            result[ok] = lowess(y[ok], int(size), rounds, np.flatnonzero(ok).astype(float))
        return result

    return _per_segment(df, track, out or f"{column}_lowess", values)


def matern_mean(y: np.ndarray, length: float, noise: float) -> np.ndarray:
    """The mean of a Gaussian process over the index with a Matern 3/2 kernel of variance var(y) plus white noise. Such a
    process is a linear recursion of two states (value and slope), so a filter forth and a smoother back give it exactly,
    in time linear in the series; values that are missing are skipped."""
    known = np.isfinite(y)
    if known.sum() < 2:
        return np.full(len(y), np.nan)
    mean, var = y[known].mean(), max(y[known].var(), 1e-12)
    rate = np.sqrt(3.0) / length
    decay = np.exp(-rate)
    step = decay * np.array([[1 + rate, 1.0], [-(rate**2), 1 - rate]])
    rest = var * np.diag([1.0, rate**2])
    drive = rest - step @ rest @ step.T
    n, unsure = len(y), noise**2 + 1e-10
    m, c = np.zeros(2), rest
    ahead_m, ahead_c, now_m, now_c = np.zeros((n, 2)), np.zeros((n, 2, 2)), np.zeros((n, 2)), np.zeros((n, 2, 2))
    for i in range(n):
        if i:
            m, c = step @ m, step @ c @ step.T + drive
        ahead_m[i], ahead_c[i] = m, c
        if known[i]:
            gain = c[:, 0] / (c[0, 0] + unsure)
            m, c = m + gain * (y[i] - mean - m[0]), c - np.outer(gain, c[0])
        now_m[i], now_c[i] = m, c
    out = np.empty(n)
    out[-1] = m[0]
    for i in range(n - 2, -1, -1):
        gain = now_c[i] @ step.T @ np.linalg.inv(ahead_c[i + 1])
        m = now_m[i] + gain @ (m - ahead_m[i + 1])
        out[i] = m[0]
    return out + mean


def gaussian_process(df: DataFrame, track: Track, column: str, length: float, noise: float, out: str | None = None) -> DataFrame:
    """Gaussian-process mean with a Matern 3/2 kernel over the record index plus white noise, at every record."""
    return _per_segment(df, track, out or f"{column}_gp", lambda pdf: matern_mean(pdf[column].to_numpy(float), length, noise))


@dataclass(frozen=True)
class SeaLevel:
    """Options: filter width in records, or (filter_width_m) in metres; tie points from these surface types; uncertainty from
    u_min at a tie point to u_max at u_dist; values farther than max_dist from a tie point are dropped. Distances are records,
    or metres with filter_width_m, converted by the segment's footprint spacing."""

    filter_window: int = 51
    filter_width_m: float | None = None
    tie_types: Sequence[str] = ("lead",)
    u_min: float = 0.02
    u_max: float = 0.10
    u_dist: float = 300.0
    max_dist: float | None = None
    least_ties: int = 1
    drop_types: Sequence[str] = ()


def tie_points(surface: Column, elevation: Column, names: Sequence[str]) -> Column:
    return F.coalesce(is_surface(surface, *names) & elevation.isNotNull(), F.lit(False))


def smoothed_linear(
    df: DataFrame, track: Track, o: SeaLevel = SeaLevel(), elevation: str = "elevation", mss: str = "mean_sea_surface", surface: str = "surface_type",
    longitude: str = "longitude", latitude: str = "latitude", spacing: str | None = None,
) -> DataFrame:
    """sea_level_anomaly_raw (at tie points), sea_level_anomaly and its uncertainty, tie_distance: tie points are
    smoothed, restricted to tie points, interpolated to all records (ends held) and smoothed again."""
    tie = tie_points(F.col(surface), F.col(elevation), o.tie_types)
    base = df.withColumns({"__tie": tie, "__pos": track.position()})
    base = base.withColumn("sea_level_anomaly_raw", F.when(F.col("__tie"), F.col(elevation) - F.col(mss)))
    window: int | str = o.filter_window
    if o.filter_width_m is not None:
        base = footprint_spacing(base, track, longitude, latitude, "__metres") if spacing is None else base.withColumn("__metres", F.col(spacing))
        window, base = "__window", base.withColumn("__window", odd_window(F.lit(float(o.filter_width_m)), F.col("__metres")))
    base = box_smooth(base, track, "sea_level_anomaly_raw", window, "__s1")
    base = base.withColumn("__s1", F.when(F.col("__tie"), F.col("__s1")))
    base = base.withColumn("__s2", fill_gaps(track, F.col("__s1"), F.col("__pos"), "hold"))
    base = box_smooth(base, track, "__s2", window, "__s3")
    distance = flag_distance(track, F.col("__tie"), F.col("__pos"))
    if o.filter_width_m is not None:
        distance = distance * F.col("__metres")
    ties = F.sum(F.col("__tie").cast("int")).over(track.whole)
    base = base.withColumns({"tie_distance": distance, "__ties": ties})
    drop = F.col("__ties") < o.least_ties
    if o.max_dist is not None:
        drop = drop | (F.col("tie_distance") > o.max_dist)
    if o.drop_types:
        drop = drop | is_surface(F.col(surface), *o.drop_types)
    sla = F.when(~drop, F.col("__s3"))
    unc = F.when(sla.isNotNull(), sea_level_uncertainty(F.col("tie_distance"), o.u_min, o.u_max, o.u_dist))
    return base.withColumns({"sea_level_anomaly": sla, "sea_level_anomaly_uncertainty": unc}).drop("__tie", "__pos", "__s1", "__s2", "__s3", "__ties", "__metres", "__window")


def raw_anomaly(surface: Column, elevation: Column, mss: Column, names: Sequence[str]) -> Column:
    return F.when(tie_points(surface, elevation, names), elevation - mss)


def deviation_filter(df: DataFrame, track: Track, column: str, half: int, up: float, down: float, low: float, high: float | None = None, window: int = 51, keep: str = "kept") -> DataFrame:
    """Keeps values strictly inside local regression + up / - down times the clamped rolling deviation of its residual."""
    base = lowess_smooth(df, track, column, window, "__fit")
    base = base.withColumn("__res", F.col(column) - F.col("__fit"))
    sd = F.stddev_samp("__res").over(track.rows(-half, half))
    sd = F.greatest(sd, F.lit(low)) if high is None else F.least(F.greatest(sd, F.lit(low)), F.lit(high))
    base = base.withColumn("__sd", sd)
    inside = (F.col("__res") < up * F.col("__sd")) & (F.col("__res") > -down * F.col("__sd"))
    return base.withColumn(keep, F.coalesce(inside, F.lit(False))).drop("__fit", "__res", "__sd")


@dataclass(frozen=True)
class IceEdge:
    """Options of the marginal zone at ice edges: filter widths in metres, freeboard gradient in metres per kilometre."""

    ice_width: float
    ocean_width: float
    smoother_width: float
    gradient_least: float
    edge_width_least: float
    post_window: int = 11


def _records(width: float, spacing: float) -> int:
    return int(width / spacing) // 2 * 2 + 1


def filtered_freeboard(freeboard: np.ndarray, window: int, post: int = 11) -> np.ndarray:
    """Local regression without gaps, then a moving mean but for `post` records at each end of what it reaches."""
    known = np.flatnonzero(np.isfinite(freeboard))
    n = len(freeboard)
    if len(known) < 2:
        return np.full(n, np.nan)
    fit = lowess(freeboard[known], window, 3, known.astype(float))
    whole = np.interp(np.arange(n), known, fit, np.nan, np.nan)
    ok = np.isfinite(whole)
    half = post // 2
    count = np.convolve(ok, np.ones(post), "full")[half : half + n]
    total = np.convolve(np.where(ok, whole, 0.0), np.ones(post), "full")[half : half + n]
    out = np.where(count > 0, total / np.maximum(count, 1), np.nan)
    first, last = max(known[0] - half, 0), min(known[-1] + half, n - 1)
    out[first : first + post] = whole[first : first + post]
    out[max(last - post, 0) : last + 1] = whole[max(last - post, 0) : last + 1]
    return out


def impacted_records(level: np.ndarray, gradient: np.ndarray, edge: int, ice_is_left: bool) -> np.ndarray:
    """From the edge to the first reversal of the freeboard's trend; reversals go on being passed while every second one
    is lower still."""
    sign = np.sign(gradient)
    turns = np.flatnonzero((sign[1:] != sign[:-1]) & np.isfinite(gradient[:-1]))[:-1]  # the last is the data's end
    if not len(turns):
        return turns
    order = turns[[len(turns) - 1, *range(len(turns) - 2, 0, -2)]] if ice_is_left else turns[::2]
    reach = order[0]
    for turn in order[1:]:
        if not level[reach] > level[turn]:
            break
        reach = turn
    return np.arange(reach, edge + 1) if ice_is_left else np.arange(edge, reach)


def ice_edge_flags(sic: np.ndarray, width: np.ndarray, freeboard: np.ndarray, distance: np.ndarray, spacing: float, o: IceEdge) -> np.ndarray:
    """-1 away from ice edges, 1 near one, 2 where the freeboard is under the waves' influence. The first edge along the
    track that says something of a record decides."""
    n = len(sic)
    flag = np.full(n, -1)
    if n < 3 or not np.isfinite(spacing) or spacing <= 0:
        return flag
    ice = sic > 15.0
    edges = [i for i in np.flatnonzero(ice[1:] != ice[:-1]).tolist() if i >= 1 and np.isfinite(sic[i - 1 : i + 2]).all()]
    if not edges:
        return flag
    level = filtered_freeboard(freeboard, _records(o.smoother_width, spacing), o.post_window)
    gradient = np.concatenate([[np.nan], np.diff(level)]) * (1000.0 / spacing)
    sloped = np.flatnonzero(np.isfinite(gradient))
    at = np.arange(n)
    for edge in edges:
        ice_is_left = bool(sic[edge + 1] < 15.0)
        near = (distance <= o.ice_width) & np.isfinite(sic) & (np.abs(at - edge) <= _records(o.ice_width, spacing))
        reach = _records(o.ocean_width, spacing)
        ocean = width[edge + 1 : min(edge + reach, n)] if ice_is_left else width[max(edge - reach, 0) : edge + 1]
        if not freeboard[near].any() or not ocean.any() or len(sloped) < 2 or not np.isfinite(ocean).any():
            continue
        at_edge = abs(gradient[sloped[-1] if ice_is_left else sloped[1]])
        mine = np.where(near, 1, 0)
        if at_edge >= o.gradient_least or np.nanmean(ocean) >= o.edge_width_least:
            hit = impacted_records(level, gradient, edge, ice_is_left)
            mine[hit[(hit >= 0) & (hit < n)]] = 2
        flag = np.where((flag == -1) & (mine > 0), mine, flag)
    return flag


def transition_zone(df: DataFrame, track: Track, sic: str, width: str, freeboard: str, distance: str, spacing: str, o: IceEdge, out: str = "flag_miz") -> DataFrame:
    """ice_edge_flags() of each segment, 0 where there is no flag. spacing: a column of metres between records."""

    def values(pdf: pd.DataFrame) -> np.ndarray:
        step = pd.to_numeric(pdf[spacing]).iloc[0] if len(pdf) else np.nan
        columns = [pd.to_numeric(pdf[c]).to_numpy(float) for c in (sic, width, freeboard, distance)]
        return np.maximum(ice_edge_flags(*columns, float(step) if step is not None else np.nan, o), 0)

    return _per_segment(df, track, out, values).withColumn(out, F.col(out).cast("tinyint"))


def smooth_grid(cells: DataFrame, column: str, out: str, reach: int = 1, cell: Sequence[str] = ("yj", "xi")) -> DataFrame:
    """2-D box mean of the values present; gaps stay gaps."""
    from firnline.operators.grid import neighbourhood

    base = neighbourhood(cells, column, "__m", reach, "mean", cell)
    return base.withColumn(out, F.when(F.col(column).isNotNull(), F.col("__m"))).drop("__m")
