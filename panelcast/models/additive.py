"""Additive trend + yearly seasonality + holiday regression per series.

The reference fits an additive forecasting library per series (``y = trend + seasonality + holidays``).
Re-aimed: Spark builds the design columns (time, Fourier terms at 365.25
days, holiday-window dummies from the spread calendar); one grouped pandas
call per (series, fold) adds piecewise-linear trend hinges and solves a
ridge least squares, returning validation predictions. ``multiplicative``
alternates the trend and the seasonal factor on all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import spread_holidays
from ..sources import schemas as S

YEAR_DAYS = 365.25
EPOCH = "1970-01-01"


def design(frame: DataFrame, calendar: DataFrame | None, fourier_order: int = 10) -> tuple[DataFrame, list[str]]:
    """Add ``t`` (years since epoch), Fourier sin/cos pairs and holiday dummies
    ``hol_<name>_<offset>`` (H17 spread joined on the row date)."""
    days = F.datediff(F.col("date"), F.lit(EPOCH).cast("date")).cast("double")
    cols, names = [(days / YEAR_DAYS).alias("t")], []
    for k in range(1, fourier_order + 1):
        ang = days * (2 * math.pi * k / YEAR_DAYS)
        cols += [F.sin(ang).alias(f"sin{k}"), F.cos(ang).alias(f"cos{k}")]
        names += [f"sin{k}", f"cos{k}"]
    out = frame.select("*", *cols)
    if calendar is not None:
        sp = spread_holidays(calendar).select(
            F.col("ds").alias("date"),
            F.concat(F.lit("hol_"), F.col("name"), F.lit("_"),
                     F.regexp_replace(F.col("offset").cast("string"), "-", "m")).alias("hname"))
        # dummies: one column per (holiday, offset) of the calendar parameter; the
        # name list and the pivot are calendar-sized (holidays x window width)
        dummy_names = [r["hname"] for r in sp.select("hname").distinct().orderBy("hname").collect()]
        wide = sp.groupBy("date").pivot("hname", dummy_names).agg(F.lit(1.0))
        out = out.join(F.broadcast(wide), "date", "left").fillna(0.0, subset=dummy_names)
        names += dummy_names
    return out, names


def _ridge(X: np.ndarray, y: np.ndarray, ridge: float, free: int = 1) -> np.ndarray:
    """Least squares with a ridge on all columns but the first ``free``."""
    pen = ridge * np.eye(X.shape[1])
    pen[:free, :free] = 0.0
    return np.linalg.solve(X.T @ X + pen, X.T @ y)


def _trend_times_season(X: np.ndarray, Xv: np.ndarray, y: np.ndarray, n_trend: int, ridge: float, rounds: int = 10) -> np.ndarray:
    """y = trend * (1 + season), by least squares for one factor given the other in turn; uses every row.

    The seasonal ridge is in units of the squared trend, so it does not depend on the scale of y.
    """
    trend, season = X[:, :n_trend], X[:, n_trend:]
    b = np.zeros(season.shape[1])
    for _ in range(rounds):
        factor = 1.0 + season @ b
        a = _ridge(trend * factor[:, None], y, ridge)
        level = trend @ a
        b = _ridge(season * level[:, None], y - level, ridge * max(float(np.mean(level ** 2)), 1e-12), free=0)
    return (Xv[:, :n_trend] @ a) * (1.0 + Xv[:, n_trend:] @ b)


def _fit_predict(features: list[str], n_knots: int, ridge: float, multiplicative: bool):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        key = {c: pdf[c].iloc[0] for c in ("store", "dept", "fold")}
        tr = pdf[pdf["role"] == "train"]
        va = pdf[pdf["role"] == "val"]
        err, pred = None, np.full(len(va), np.nan)
        try:
            if len(tr) < 30 or len(va) == 0:
                raise ValueError("fold guard: train < 30 rows or empty validation")
            ytr = tr["y"].to_numpy(dtype=float)
            t0, t1 = float(tr["t"].min()), float(tr["t"].max())
            span = max(t1 - t0, 1e-9)
            knots = t0 + span * 0.8 * np.arange(1, n_knots + 1) / (n_knots + 1)

            def mat(part):
                t = (part["t"].to_numpy(dtype=float) - t0) / span
                cols = [np.ones(len(part)), t] + [np.maximum(0.0, t - (k - t0) / span) for k in knots]
                cols += [part[f].to_numpy(dtype=float) for f in features]
                return np.column_stack(cols)

            X, Xv = mat(tr), mat(va)
            if multiplicative:
                pred = _trend_times_season(X, Xv, ytr, 2 + n_knots, ridge)
            else:
                pred = Xv @ _ridge(X, ytr, ridge)
        except Exception as e:  # noqa: BLE001  K25
            err = str(e)
        out = va[["date", "y", "is_holiday"]].copy()
        for k, v in key.items():
            out[k] = v
        out["y_pred"] = pred
        out["error"] = err
        if len(out) == 0:
            out = pd.DataFrame([{**key, "date": pd.NaT, "y": np.nan, "is_holiday": None,
                                 "y_pred": np.nan, "error": err}])
        return out[["store", "dept", "fold", "date", "y", "is_holiday", "y_pred", "error"]]
    return fn


def evaluate_additive(frame: DataFrame, calendar: DataFrame | None, fourier_order: int = 10, n_knots: int = 5,
                      ridge: float = 1.0, multiplicative: bool = False) -> DataFrame:
    """K21/K22 (+J6 with ``calendar=None``): per (series, fold) validation predictions."""
    from .ar import PRED_SCHEMA, fit_groups
    d, names = design(frame, calendar, fourier_order)
    cols = ["store", "dept", "fold", "date", "y", "is_holiday", "role", "t", *names]
    return fit_groups(d.select(*cols), ["store", "dept", "fold"]).applyInPandas(
        _fit_predict(names, n_knots, ridge, multiplicative), PRED_SCHEMA)


def future_dates(df: DataFrame, periods: int, keys=S.KEYS, date: str = "date",
                 include_history: bool = True) -> DataFrame:
    """History dates plus ``periods`` weekly dates after each series' last date."""
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    fut = last.select(*keys, F.explode(F.sequence(F.date_add("_last", 7), F.date_add("_last", 7 * periods),
                                                  F.expr("INTERVAL 7 DAYS"))).alias(date),
                      F.lit(True).alias("is_future"))
    if not include_history:
        return fut
    hist = df.select(*keys, date, F.lit(False).alias("is_future"))
    return hist.unionByName(fut)
