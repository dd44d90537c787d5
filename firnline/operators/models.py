"""Adapters for external models: waveform fits and predicted retracker thresholds. The models themselves (physics packages,
trained weights) are given by the caller; these adapters batch, bound and merge their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predicted_threshold(model: Callable[[], Callable[[np.ndarray], np.ndarray]], low: float, high: float, bins: int = 35, lead: int = 10):
    """A pandas UDF power -> threshold: the normalised window of `bins` bins around the first maximum through a model that each
    worker loads once; clipped to the valid range, NULL where there is no usable waveform."""
    from firnline.operators.retrack import FirstMaximum, prepare

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = model()
        for power in batches:
            good = power.notna() & power.map(lambda w: w is not None and len(w) >= bins and bool(np.isfinite(np.asarray(w, float)).all()) and max(w) > 0)
            out = np.full(len(power), np.nan)
            if good.any():
                w = np.stack([np.asarray(x, float) for x in power[good]])
                o = FirstMaximum(oversampling=1, smoothing=(1, 1, 1))
                p = prepare(np.zeros_like(w), w, np.zeros(len(w), np.int64), np.ones(len(w), bool), o)
                first = np.clip(p.fmi - lead, 0, w.shape[1] - bins)
                windows = p.power[np.arange(len(w))[:, None], first[:, None] + np.arange(bins)]
                out[good.to_numpy()] = np.clip(np.asarray(run(windows), float).ravel(), low, high)
            yield pd.Series(out).where(np.isfinite(out), None)

    return predict


def fit_waveforms(df: DataFrame, key: Sequence[str], power: str, ranges: str, fit: Callable[[np.ndarray, np.ndarray], dict], outputs: Sequence[str], misfit: str = "misfit", most: float | None = None) -> DataFrame:
    """A model fit per waveform, task-parallel over Arrow batches: fit(power, ranges) -> {output: float}. Failed fits and fits
    with a misfit above `most` are NULL."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in key), *(f"`{c}` double" for c in outputs)])

    def run(frames):
        for pdf in frames:
            rows = []
            for w, r in zip(pdf[power], pdf[ranges]):
                got = None
                if w is not None and r is not None and len(w) and np.isfinite(np.asarray(w, float)).all():
                    try:
                        got = fit(np.asarray(w, float), np.asarray(r, float))
                    except (ArithmeticError, ValueError, np.linalg.LinAlgError):
                        got = None
                if got is not None and most is not None and not got.get(misfit, 0.0) <= most:
                    got = None
                rows.append([None if got is None else got.get(c) for c in outputs])
            yield pd.concat([pdf[list(key)].reset_index(drop=True), pd.DataFrame(rows, columns=list(outputs), dtype=object)], axis=1)

    return df.join(df.select(*key, power, ranges).mapInPandas(run, schema), list(key), "left")


def parameter_deviations(jacobian: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Standard deviations of least-squares parameters."""
    n, k = jacobian.shape
    variance = float(residual @ residual) / max(n - k, 1)
    return np.sqrt(np.maximum(np.diag(np.linalg.pinv(jacobian.T @ jacobian)) * variance, 0))
