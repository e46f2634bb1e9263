"""Leakage-safe panel features as window functions.

All per-series windows share one spec ``partitionBy(store, dept).orderBy(date)``
and are emitted in one ``select`` so Catalyst plans one Exchange + Sort +
Window for the lot. A series' partition is its number of weeks, bounded by
the calendar, so no task grows with the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_to_nearest_holiday
from ..sources import schemas as S

TARGET = "weekly_sales"


def series_window(keys: list[str] = S.KEYS, date: str = "date"):
    return Window.partitionBy(*keys).orderBy(date)


def lag_columns(lags=(1, 2, 4, 52), target: str = TARGET, keys=S.KEYS, date="date"):
    """Row-based lags (T1: gaps shift the meaning, by design)."""
    w = series_window(keys, date)
    return [F.lag(target, k).over(w).alias(f"sales_lag_{k}") for k in lags]


def rolling_columns(windows=(4, 8), target: str = TARGET, keys=S.KEYS, date="date"):
    """E2 + E3: mean and sample std over the previous ``w`` rows."""
    w0 = series_window(keys, date)
    out = []
    for n in windows:
        w = w0.rowsBetween(-n, -1)
        out.append(F.avg(target).over(w).alias(f"sales_rolling_mean_{n}"))
        out.append(F.stddev_samp(target).over(w).alias(f"sales_rolling_std_{n}"))
    return out


def rolling_exact_columns(windows=(4, 8), target: str = "cents", scale: float = 100.0, keys=S.KEYS, date="date"):
    """E2 + E3 for an integer-valued measure (e.g. cents): exact moments.

    Sums and sums of squares are exact decimals, so mean and sample std do
    not depend on summation order (identical across partitionings and
    engines). Results are divided by ``scale`` (cents -> currency).
    """
    w0 = series_window(keys, date)
    x = F.col(target).cast("decimal(38,0)")
    out = []
    for n in windows:
        w = w0.rowsBetween(-n, -1)
        cnt = F.count(target).over(w)
        s1 = F.sum(x).over(w)
        s2 = F.sum(x * x).over(w)
        mean = F.when(cnt >= 1, s1.cast("double") / cnt) / F.lit(scale)
        var = F.when(cnt >= 2, (cnt * s2 - s1 * s1).cast("double") / (cnt * (cnt - 1)))
        out.append(mean.alias(f"sales_rolling_mean_{n}"))
        out.append((F.sqrt(var) / F.lit(scale)).alias(f"sales_rolling_std_{n}"))
    return out


def add_lag_features(df: DataFrame, lags=(1, 2, 4, 52), target: str = TARGET) -> DataFrame:
    return df.select("*", *lag_columns(lags, target))


def add_rolling_features(df: DataFrame, windows=(4, 8), target: str = TARGET) -> DataFrame:
    return df.select("*", *rolling_columns(windows, target))


def add_series_window_features(df: DataFrame, lags=(1, 2, 4, 52), windows=(4, 8),
                               target: str = TARGET) -> DataFrame:
    """E1 + E2 + E3 in one projection: one shuffle, one sort."""
    return df.select("*", *lag_columns(lags, target), *rolling_columns(windows, target))


def add_holiday_proximity(df: DataFrame, holidays, date: str = "date") -> DataFrame:
    """Signed days to the nearest holiday (literal calendar, no join)."""
    return df.withColumn("days_to_nearest_holiday", days_to_nearest_holiday(date, holidays))


def _expanding_group_avg(df: DataFrame, group: str, out: str, target: str, date: str) -> DataFrame:
    # Mean per (group, date) with map-side partial aggregation, then the
    # expanding mean of those means over earlier dates only.
    per_date = (S.null_key_guard(df, [group, date])
                .groupBy(group, date).agg(F.avg(target).alias("_m")))
    w = Window.partitionBy(group).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    snap = per_date.select(group, date, F.avg("_m").over(w).alias(out))
    # plain join: Spark broadcasts the (group, date) table from its measured size while it is small
    return df.join(snap, [group, date], "left")


def add_expanding_dept_avg(df: DataFrame, target: str = TARGET, date: str = "date") -> DataFrame:
    """E4 (+C5): expanding mean of per-date dept means, excluding the current date."""
    return _expanding_group_avg(df, "dept", "dept_avg_sales_expanding", target, date)


def add_expanding_store_avg(df: DataFrame, target: str = TARGET, date: str = "date") -> DataFrame:
    """E5 (+C5): same per store."""
    return _expanding_group_avg(df, "store", "store_avg_sales_expanding", target, date)


def add_prior_year_sales(df: DataFrame, history: DataFrame | None = None, target: str = TARGET,
                         out: str = "sales_lag_52wk") -> DataFrame:
    """Value of the same series in the previous calendar year, same ISO week.

    ``history`` is the frame the values come from (default: ``df`` itself);
    it is pre-aggregated on the key so a non-unique (year, week) key, as in
    daily data, cannot fan rows out.
    """
    history = df if history is None else history
    prior = (history.groupBy("store", "dept",
                             (F.year("date") + 1).alias("_year"), F.weekofyear("date").alias("_week"))
             .agg(F.avg(target).alias(out)))
    keyed = df.withColumn("_year", F.year("date")).withColumn("_week", F.weekofyear("date"))
    return keyed.join(prior, ["store", "dept", "_year", "_week"], "left").drop("_year", "_week")


def add_differences(df: DataFrame, target: str = TARGET, season: int = 52) -> DataFrame:
    """First difference and seasonal difference (row based)."""
    w = series_window()
    return df.select("*", (F.col(target) - F.lag(target, 1).over(w)).alias("diff_1"),
                     (F.col(target) - F.lag(target, season).over(w)).alias(f"diff_{season}"))


def undifference(df: DataFrame, diff: str = "diff_1", level: str = "weekly_sales", out: str = "level",
                 keys=S.KEYS, date: str = "date") -> DataFrame:
    """E8 inverse: levels from first differences, a running sum from the first level."""
    w = series_window(keys, date)
    first = F.first(level).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    run = F.sum(diff).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, first + F.coalesce(run, F.lit(0)))


def build_all_features(df: DataFrame, holidays) -> DataFrame:
    """K3: lags, rolling stats, holiday proximity, expanding dept and store means."""
    df = add_series_window_features(df)
    df = add_holiday_proximity(df, holidays)
    df = add_expanding_dept_avg(df)
    return add_expanding_store_avg(df)
