"""Global linear model on decomposed windows (K12, DLinear re-aimed).

The reference network is linear in its input: trend and seasonal parts of
an instance-normalised lookback window, each through a linear layer. Here
each horizon step is one weighted ridge fit over all windows of all series.

Fitting is one pass. Every task sums the second moments of its windows in
Arrow batches (numpy, a few thousand numbers whatever the rows); an aggregate
merges them, and the steps are solved from the merged sums. A holiday step
weighs ``HOLIDAY_WEIGHT`` and any other 1, so a step's weighted moments are
those of all windows plus ``HOLIDAY_WEIGHT - 1`` times those of its holiday
windows, and the window rows are read once for all steps and stored nowhere.
The decomposition is a linear map of the window, so it is applied to the
moments, not to the rows.

``fit_direct`` minimises the squared error. ``fit_absolute`` minimises the
weighted absolute error by iteratively reweighted least squares: a round is
one pass in which every task weighs its windows by the size of their last
residuals and sums the same moments.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import HOLIDAY_WEIGHT
from ..session import materialize

EPS = 1e-6


def trend_matrix(lookback: int, kernel: int = 25) -> np.ndarray:
    """I6 as a matrix: row i averages the ``kernel`` values around i, ends clamped to the first / last value."""
    left = (kernel - 1) // 2
    m = np.zeros((lookback, lookback))
    for i in range(lookback):
        for j in range(i - left, i - left + kernel):
            m[i, min(max(j, 0), lookback - 1)] += 1.0 / kernel
    return m


def normalized(windows: DataFrame, eps: float = EPS) -> DataFrame:
    """``x`` and ``y`` by the window's own mean and population std; ``h`` as it is."""
    scale = lambda c: F.transform(c, lambda v: (v - F.col("mu")) / F.col("sd"))
    w = windows.select("x", "y", "h", F.col("x_mean").alias("mu"), (F.col("x_std") + F.lit(eps)).alias("sd"))
    return w.select(scale("x").alias("x"), scale("y").alias("y"), "h")


def window_moments(windows: DataFrame, horizon: int) -> DataFrame:
    """``(step, row, sums)``: second moments of ``z = [1, x, y]`` over all windows (step -1), and of
    ``[1, x, y_step]`` over the windows whose ``h`` holds at that step. One pass; each task sends one matrix per step."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if not len(b):
                continue
            x, y = np.stack(b["x"].to_numpy()).astype(float), np.stack(b["y"].to_numpy()).astype(float)
            h = np.stack(b["h"].to_numpy()).astype(bool)
            zx = np.column_stack([np.ones(len(x)), x])
            z = np.column_stack([zx, y])
            own = [z.T @ z]
            for s in range(horizon):
                zs = np.column_stack([zx, y[:, s]])[h[:, s]]
                own.append(zs.T @ zs)
            total = own if total is None else [t + o for t, o in zip(total, own)]
        for k, m in enumerate(total or []):
            yield pd.DataFrame({"step": np.full(len(m), k - 1, dtype="int32"), "row": np.arange(len(m), dtype="int32"), "sums": list(m)})

    parts = windows.select("x", "y", "h").mapInPandas(partial, "step int, row int, sums array<double>")
    merged = parts.groupBy("step", "row").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return merged.select("step", "row", vector_to_array("sums").alias("sums"))


def weighted_moments(moments: DataFrame, horizon: int) -> list[np.ndarray]:
    """Per step the weighted moments of ``[1, x, y_step]``; reads (horizon + 1) small matrices."""
    rows: dict[int, dict[int, list[float]]] = {}
    for r in moments.collect():  # model-sized: (horizon + 1) * (1 + lookback + horizon) rows
        rows.setdefault(r["step"], {})[r["row"]] = r["sums"]
    if not rows:
        raise ValueError("no training windows")
    full = {k: np.array([m[i] for i in range(len(m))]) for k, m in rows.items()}
    n_x = len(full[-1]) - horizon
    out = []
    for s in range(horizon):
        keep = [*range(n_x), n_x + s]
        out.append(full[-1][np.ix_(keep, keep)] + (HOLIDAY_WEIGHT - 1) * full[s])
    return out


def _parts(lookback: int, kernel: int) -> np.ndarray:
    """Map of a window to ``trend ++ seasonal``."""
    trend = trend_matrix(lookback, kernel)
    return np.vstack([trend, np.eye(lookback) - trend])


def _solve(g: np.ndarray, parts: np.ndarray, total: float, reg: float) -> tuple[list[float], float]:
    """(coefficients, intercept) that minimise the weighted squared error over ``total`` plus ``reg`` times the squared
    coefficients; ``g`` are the weighted moments of ``[1, x, y]``, the intercept is free."""
    w, sx, sy = g[0, 0], parts @ g[0, 1:-1], g[0, -1]
    xx = parts @ g[1:-1, 1:-1] @ parts.T - np.outer(sx, sx) / w
    xy = parts @ g[1:-1, -1] - sx * sy / w
    coef = np.linalg.solve(xx / total + reg * np.eye(len(xx)), xy / total)
    return [float(v) for v in coef], float((sy - sx @ coef) / w)


def fit_direct(train_windows: DataFrame, horizon: int, reg: float = 0.1, kernel: int = 25) -> list[tuple[list[float], float]]:
    """One weighted ridge fit per horizon step on ``trend ++ seasonal``; (coefficients, intercept) per step.

    Minimises the weighted mean squared error plus ``reg`` times the squared
    coefficients; the intercept is free.
    """
    moments = weighted_moments(window_moments(normalized(train_windows), horizon), horizon)
    return [_solve(g, _parts(len(g) - 2, kernel), g[0, 0], reg) for g in moments]


@dataclass
class AbsoluteFit:
    """``coefs`` as ``fit_direct`` gives them; ``rounds`` holds (weighted mean absolute error, objective) before each round
    and after the last, summed over the steps."""
    coefs: list[tuple[list[float], float]]
    rounds: list[tuple[float, float]]
    converged: bool


def residual_moments(windows: DataFrame, coefs: list[tuple[list[float], float]], kernel: int, delta: float) -> DataFrame:
    """``(step, row, sums)`` over normalised windows: moments of ``[1, x, y_step]`` weighted by the holiday weight over
    ``sqrt(r^2 + delta^2)``, r being the residual of ``coefs``; row -1 holds the step's weighted sums of ``|r|``, of that
    root, and of the holiday weight. One pass; each task sends one matrix per step."""
    lookback = len(coefs[0][0]) // 2
    per_value = np.array([c for c, _ in coefs]) @ _parts(lookback, kernel)
    intercept = np.array([b for _, b in coefs])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        moments = np.zeros((len(coefs), lookback + 2, lookback + 2))
        sums = np.zeros((len(coefs), 3))
        for b in batches:
            if not len(b):
                continue
            x, y = np.stack(b["x"].to_numpy()).astype(float), np.stack(b["y"].to_numpy()).astype(float)
            weight = np.where(np.stack(b["h"].to_numpy()).astype(bool), float(HOLIDAY_WEIGHT), 1.0)
            r = y - (x @ per_value.T + intercept)
            root = np.sqrt(r * r + delta * delta)
            sums += np.stack([(weight * np.abs(r)).sum(0), (weight * root).sum(0), weight.sum(0)], axis=1)
            z = np.column_stack([np.ones(len(x)), x, np.zeros(len(x))])
            for s in range(len(coefs)):
                z[:, -1] = y[:, s]
                moments[s] += z.T @ (z * (weight[:, s] / root[:, s])[:, None])
        for s in range(len(coefs)):
            rows = np.arange(-1, lookback + 2, dtype="int32")
            yield pd.DataFrame({"step": np.full(len(rows), s, dtype="int32"), "row": rows,
                                "sums": [np.pad(sums[s], (0, lookback - 1)), *moments[s]]})

    parts = windows.select("x", "y", "h").mapInPandas(partial, "step int, row int, sums array<double>")
    merged = parts.groupBy("step", "row").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return merged.select("step", "row", vector_to_array("sums").alias("sums"))


def fit_absolute(train_windows: DataFrame, horizon: int, reg: float = 0.01, kernel: int = 25, delta: float = 1e-3,
                 tol: float = 1e-4, max_rounds: int = 50) -> AbsoluteFit:
    """Per horizon step the least weighted mean absolute error plus ``reg / 2`` times the squared coefficients.

    Starts at the squared-error fit. The absolute value is smoothed to
    ``sqrt(r^2 + delta^2)`` (residuals are in units of a window's standard
    deviation), for which each round cannot raise the objective. Ends when a
    round lowers it by less than ``tol`` of it, or after ``max_rounds``. The
    normalised windows are written once and read once a round.
    """
    w = materialize(normalized(train_windows))
    coefs = [_solve(g, _parts(len(g) - 2, kernel), g[0, 0], reg) for g in weighted_moments(window_moments(w, horizon), horizon)]
    parts, rounds = _parts(len(coefs[0][0]) // 2, kernel), []
    while True:
        got: dict[int, dict[int, list[float]]] = {}
        for r in residual_moments(w, coefs, kernel, delta).collect():  # model-sized: horizon * (lookback + 3) rows
            got.setdefault(r["step"], {})[r["row"]] = r["sums"]
        heads = np.array([got[s][-1][:3] for s in range(horizon)])
        penalty = 0.5 * reg * sum(float(np.dot(c, c)) for c, _ in coefs)
        rounds.append((float((heads[:, 0] / heads[:, 2]).sum()), float((heads[:, 1] / heads[:, 2]).sum()) + penalty))
        converged = len(rounds) > 1 and rounds[-2][1] - rounds[-1][1] <= tol * rounds[-2][1]
        if converged or len(rounds) > max_rounds:
            return AbsoluteFit(coefs, rounds, converged)
        coefs = [_solve(np.array([got[s][i] for i in range(len(got[s]) - 1)]), parts, heads[s, 2], reg) for s in range(horizon)]


def predict_windows(windows: DataFrame, coefs: list[tuple[list[float], float]], kernel: int = 25, eps: float = EPS) -> DataFrame:
    """Forecast array per window: one matrix product per Arrow batch; NULL for a window of another length than the fitted one."""
    lookback = len(coefs[0][0]) // 2
    trend = trend_matrix(lookback, kernel)
    c = np.array([v for v, _ in coefs])
    per_value = (c[:, :lookback] @ trend + c[:, lookback:] @ (np.eye(lookback) - trend)).T
    intercept = np.array([b for _, b in coefs])

    @F.pandas_udf("array<double>")
    def forecast(x: pd.Series, mu: pd.Series, sd: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(x), dtype=object)
        ok = np.array([v is not None and len(v) == lookback for v in x], dtype=bool)
        if ok.any():
            m, s = mu.to_numpy(dtype=float)[ok][:, None], sd.to_numpy(dtype=float)[ok][:, None] + eps
            xn = (np.stack(x[ok].to_numpy()).astype(float) - m) / s
            for i, f in zip(np.flatnonzero(ok), (xn @ per_value + intercept) * s + m):
                out.iat[i] = f
        return out

    return windows.withColumn("forecast", forecast("x", "x_mean", "x_std"))


def score_windows(pred: DataFrame, keys=("store", "dept")) -> DataFrame:
    """D12/D13 on window forecasts: explode (y, forecast, h) and aggregate."""
    e = pred.select(*keys, F.posexplode(F.arrays_zip("y", "forecast", "h")).alias("step", "v"))
    return e.select(*keys, "step", F.col("v.y").alias("y"), F.col("v.forecast").alias("y_pred"),
                    F.col("v.h").alias("is_holiday"))
