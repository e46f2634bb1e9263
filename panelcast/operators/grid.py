"""Regular weekly grids: densify, pad.

The grid is generated per series with ``sequence`` + ``explode`` (a
generator on one row per series, not a join of two relations), then the
observed rows are attached with one equi-join on (store, dept, date).
Global bounds come from scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import weekly_dates
from ..sources import schemas as S
from .prep import ffill


def global_grid(df: DataFrame, keys=S.KEYS, date: str = "date") -> DataFrame:
    """I1 + I2 grid: every series x every Friday between the global first and last date."""
    first = df.agg(F.min(date)).scalar()
    last = df.agg(F.max(date)).scalar()
    ids = df.select(*keys).distinct()
    return ids.select(*keys, F.explode(weekly_dates(first, last)).alias(date))


def series_grid(df: DataFrame, keys=S.KEYS, date: str = "date") -> DataFrame:
    """I3 grid: every Friday between each series' own first and last date."""
    b = df.groupBy(*keys).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    return b.select(*keys, F.explode(weekly_dates(F.col("_first"), F.col("_last"))).alias(date))


def reindex_global(df: DataFrame, target: str = "weekly_sales", keys=S.KEYS, date: str = "date",
                   fill: float | None = 0.0, holiday_from: str | Callable[[Column], Column] = "row") -> DataFrame:
    """Densify every series onto the global weekly grid.

    ``fill`` replaces missing targets (0.0 as in the reference; None keeps NULL).
    ``holiday_from='row'`` sets the flag of inserted weeks to False (T18
    parity); a callable ``f(date_col) -> Column`` derives it from the calendar.
    """
    grid = global_grid(df, keys, date)
    return _attach(grid, df, target, keys, date, fill, holiday_from)


def reindex_series(df: DataFrame, target: str = "weekly_sales", keys=S.KEYS, date: str = "date",
                   fill: float | None = 0.0, holiday_from: str | Callable[[Column], Column] = "row") -> DataFrame:
    """I3 (zero fill) / I4 (``fill=None``): densify each series between its own ends."""
    grid = series_grid(df, keys, date)
    return _attach(grid, df, target, keys, date, fill, holiday_from)


def _attach(grid, df, target, keys, date, fill, holiday_from):
    cols = [target] + (["is_holiday"] if "is_holiday" in df.columns else [])
    j = grid.join(df.select(*keys, date, *cols), [*keys, date], "left")
    y = F.coalesce(F.col(target), F.lit(fill)) if fill is not None else F.col(target)
    out = [*[F.col(k) for k in keys], F.col(date), y.alias(target),
           F.col(target).isNull().alias("is_filled")]
    if "is_holiday" in df.columns:
        if holiday_from == "row":
            h = F.coalesce(F.col("is_holiday"), F.lit(False))
        else:
            h = F.coalesce(F.col("is_holiday"), holiday_from(F.col(date)))
        out.append(h.alias("is_holiday"))
    return j.select(out)


def densify_ffill(df: DataFrame, target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """I4 + E6: per-series regular frequency with NULLs, then forward fill."""
    d = reindex_series(df, target, keys, date, fill=None)
    return ffill(d, [target], keys, [date])


def series_arrays(df: DataFrame, target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """Series object list: one row per series with date-ordered ``dates`` and ``values``.

    A series has one row per week, so the array is bounded by the calendar.
    """
    s = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(date), F.col(target)))).alias("_s"))
    return s.select(*keys, F.col(f"_s.{date}").alias("dates"), F.col(f"_s.{target}").alias("values"))


def pad_if_short(arr: Column, min_len: int) -> Column:
    """Left-pad an array with zeros up to ``min_len``."""
    pad = F.greatest(F.lit(0), F.lit(min_len) - F.size(arr))
    return F.concat(F.array_repeat(F.lit(0.0), pad), arr)
