"""Sliding-window samples and array transforms.

Windows are built with ``collect_list`` over row frames of the series
window (one shuffle by series, one sort), then filtered to full-size
frames. The expansion (lookback + horizon values per row) happens inside
the task that holds the series; select only the needed columns before it
and never cache the expanded frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import schemas as S


def _series_w(keys, date):
    return Window.partitionBy(*keys).orderBy(date)


def _window_stats(target: str, frame):
    # Lookback mean and population std computed by the Window operator itself:
    # array lambdas then reference plain attributes (an expression referenced
    # inside a lambda is re-evaluated per element once projections collapse).
    return [F.avg(target).over(frame).alias("x_mean"), F.stddev_pop(target).over(frame).alias("x_std")]


def build_windows(df: DataFrame, lookback: int = 52, horizon: int = 13, val_horizon: int = 13,
                  target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """I8 (and I10 with ``val_horizon=0``): row-contiguous train windows.

    One row per window: ``keys, origin`` (date of the first target week),
    ``x`` (previous ``lookback`` values), ``y`` and ``h`` (next ``horizon``
    values and holiday flags). Only series with at least
    ``lookback + horizon + val_horizon`` rows contribute, and windows end
    before the last ``val_horizon`` rows: per series ``n - val - horizon - lookback + 1``.
    """
    w = _series_w(keys, date)
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    fx = w.rowsBetween(-lookback, -1)
    x = F.collect_list(target).over(fx)
    y = F.collect_list(target).over(w.rowsBetween(0, horizon - 1))
    h = F.collect_list(F.coalesce(F.col("is_holiday"), F.lit(True))).over(w.rowsBetween(0, horizon - 1))
    t = df.select(*keys, date, rn.alias("_rn"), n.alias("_n"), x.alias("x"), y.alias("y"), h.alias("h"),
                  *_window_stats(target, fx))
    keep = ((F.col("_n") >= lookback + horizon + val_horizon) & (F.col("_rn") > lookback)
            & (F.col("_rn") + horizon - 1 <= F.col("_n") - val_horizon))
    return t.filter(keep).select(*keys, F.col(date).alias("origin"), "x", "y", "h", "x_mean", "x_std")


def validation_windows(df: DataFrame, lookback: int = 52, horizon: int = 13, val_horizon: int = 13,
                       target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """One window per series: x = the ``lookback`` rows before the
    last ``val_horizon`` rows, y/h = up to ``horizon`` rows from there."""
    w = _series_w(keys, date)
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    fx = w.rowsBetween(-lookback, -1)
    x = F.collect_list(target).over(fx)
    y = F.collect_list(target).over(w.rowsBetween(0, min(horizon, val_horizon) - 1))
    h = F.collect_list(F.coalesce(F.col("is_holiday"), F.lit(True))).over(
        w.rowsBetween(0, min(horizon, val_horizon) - 1))
    t = df.select(*keys, date, rn.alias("_rn"), n.alias("_n"), x.alias("x"), y.alias("y"), h.alias("h"),
                  *_window_stats(target, fx))
    keep = (F.col("_n") >= lookback + horizon + val_horizon) & (F.col("_rn") == F.col("_n") - val_horizon + 1)
    return t.filter(keep).select(*keys, F.col(date).alias("origin"), "x", "y", "h", "x_mean", "x_std")


def tail_rows(df: DataFrame, n_last: int, keys=S.KEYS, date: str = "date") -> DataFrame:
    """The last ``n_last`` rows of every series."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(date).desc()))
    return df.withColumn("_rk", rn).filter(F.col("_rk") <= n_last).drop("_rk")


def inference_windows(df: DataFrame, lookback: int = 52, target: str = "weekly_sales", keys=S.KEYS,
                      date: str = "date") -> DataFrame:
    """Last ``lookback`` values of each series (fewer if the series is shorter),
    with the series' last date and length."""
    t = tail_rows(df.select(*keys, date, target), lookback, keys, date)
    g = t.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(date, target))).alias("_s"),
                             F.max(date).alias("last_date"), F.avg(target).alias("x_mean"),
                             F.stddev_pop(target).alias("x_std"))
    return g.select(*keys, "last_date", F.col(f"_s.{target}").alias("x"), F.size("_s").alias("n_x"),
                    "x_mean", "x_std")


def forecast_rows(df: DataFrame, arr: str = "forecast", origin: str = "last_date", step_days: int = 7,
                  out: str = "y_pred") -> DataFrame:
    """Forecast array -> one row per step, date = origin + 7 * (step + 1)."""
    keep = [c for c in df.columns if c not in (arr,)]
    e = df.select(*keep, F.posexplode(arr).alias("step", out))
    return e.withColumn("date", F.date_add(F.col(origin), (F.col("step") + 1) * step_days))


# ---- array transforms ------------------------------------------------------

def moving_average(arr: Column, kernel: int = 25) -> Column:
    """Centred moving average with edge-replicated padding (length preserved)."""
    left = (kernel - 1) // 2
    right = kernel - 1 - left
    padded = F.concat(F.array_repeat(F.element_at(arr, 1), left), arr,
                      F.array_repeat(F.element_at(arr, -1), right))
    idx = F.sequence(F.lit(1), F.size(arr))
    # an array of one element binds the padded array, so that it is built once
    return F.transform(F.array(padded), lambda p: F.transform(
        idx, lambda i: F.aggregate(F.slice(p, i, kernel), F.lit(0.0), lambda acc, v: acc + v) / kernel))[0]


def decompose(arr: Column, kernel: int = 25) -> tuple[Column, Column]:
    """(trend, seasonal = x - trend)."""
    trend = moving_average(arr, kernel)
    return trend, F.zip_with(arr, trend, lambda a, b: a - b)


def array_mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / F.size(arr)


def array_pop_std(arr: Column) -> Column:
    m = array_mean(arr)
    return F.sqrt(F.aggregate(arr, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / F.size(arr))


def instance_normalize(arr: Column, mean: Column | None = None, std: Column | None = None,
                       eps: float = 1e-6) -> tuple[Column, Column, Column]:
    """(normalised array, mean, population std + eps) of a window (T4).

    Pass the window builders' ``x_mean`` / ``x_std`` columns: statistics given
    as array expressions are re-evaluated for every element inside the lambda.
    """
    m = array_mean(arr) if mean is None else mean
    s = (array_pop_std(arr) if std is None else std) + F.lit(eps)
    return F.transform(arr, lambda v: (v - m) / s), m, s


def denormalize(arr: Column, mean: Column, std: Column) -> Column:
    """I7 inverse."""
    return F.transform(arr, lambda v: v * std + mean)


def edge_moving_average_rows(df: DataFrame, target: str = "weekly_sales", kernel: int = 25,
                             keys=S.KEYS, date: str = "date", out: str = "trend") -> DataFrame:
    """E9 in row form: centred mean over ``kernel`` rows with ends clamped to the
    first / last value (same as edge replication)."""
    half_l = (kernel - 1) // 2
    half_r = kernel - 1 - half_l
    w = Window.partitionBy(*keys).orderBy(date)
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    first = F.first(target).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.last(target).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inner = F.sum(target).over(w.rowsBetween(-half_l, half_r))
    n_left_pad = F.greatest(F.lit(0), F.lit(half_l + 1) - rn)
    n_right_pad = F.greatest(F.lit(0), rn + half_r - n)
    total = inner + n_left_pad * first + n_right_pad * last
    return df.withColumn(out, total / kernel)
