"""Panel preparation: merge, clean, fills, row filters.

Joins carry no hint: Spark broadcasts a side while its size is under
``spark.sql.autoBroadcastJoinThreshold``, also from sizes measured at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import schemas as S


def merge_all(sales: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """C1 + C2 + B3: sales LEFT JOIN features ON (store, date) LEFT JOIN stores ON store.

    Overlapping feature columns are dropped in favour of the sales side
    (the reference suffixes them ``_feat`` and drops ``IsHoliday_feat``). A
    sales row with a NULL key matches nothing and stays.
    """
    overlap = [c for c in features.columns if c in sales.columns and c not in ("store", "date")]
    feat = features.drop(*overlap)
    st = stores.drop(*[c for c in stores.columns if c in sales.columns and c != "store"])
    return sales.join(feat, ["store", "date"], "left").join(st, "store", "left")


def flag_consistency(sales: DataFrame, features: DataFrame, flag: str = "is_holiday") -> DataFrame:
    """Inner join on (store, date); rows and rows whose flags differ (NULL-safe)."""
    f = features.select("store", "date", F.col(flag).alias("_feat_flag"))
    j = sales.select("store", "date", flag).join(f, ["store", "date"], "inner")
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(~F.col(flag).eqNullSafe(F.col("_feat_flag"))).alias("n_mismatch"))


def fill_zero(df: DataFrame, cols: list[str] = S.MARKDOWNS) -> DataFrame:
    """H8: NULL -> 0 for the listed columns."""
    return df.fillna(0.0, subset=[c for c in cols if c in df.columns])


def ffill(df: DataFrame, cols: list[str], partition: list[str], order: list[str]) -> DataFrame:
    """Forward fill (last non-null at or before the row) within a partition."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select([F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def bfill(df: DataFrame, cols: list[str], partition: list[str], order: list[str]) -> DataFrame:
    """Backward fill (first non-null at or after the row) within a partition."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return df.select([F.first(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def ffill_store_level(df: DataFrame, cols: list[str], key: str = "store", date: str = "date") -> DataFrame:
    """E6 for store-week attributes on a merged (store, dept, date) frame.

    The attribute depends only on (store, date) (T12), so the fill runs on
    the distinct (store, date) rows and joins back: a store holding a third
    of all rows still only contributes one row per week to the window, and
    the fill sees only the dates of the frame passed in (T13).
    """
    keyed = (df.groupBy(key, date).agg(*[F.max(c).alias(c) for c in cols]))
    filled = ffill(keyed, cols, [key], [date])
    return df.drop(*cols).join(filled, [key, date], "left").select(df.columns)


def clean_data(df: DataFrame, zero_cols: list[str] = S.MARKDOWNS,
               ffill_cols: tuple[str, ...] = ("cpi", "unemployment"),
               order_by: str = "date") -> DataFrame:
    """H8 + E6: markdowns NULL -> 0; cpi/unemployment forward-filled per store.

    ``order_by='date'`` fills along time (skew-safe store-week form);
    ``order_by='dept'`` reproduces the reference's row order (dept, date)
    inside each store, for literal parity on small data.
    """
    df = fill_zero(df, zero_cols)
    cols = [c for c in ffill_cols if c in df.columns]
    if not cols:
        return df
    if order_by == "dept":
        return ffill(df, cols, ["store"], ["dept", "date"])
    return ffill_store_level(df, cols)


# ---- projection / filter helpers (B1-B16) ---------------------------------

def series_id(store: str = "store", dept: str = "dept") -> Column:
    """``store_dept`` string id."""
    return F.concat_ws("_", F.col(store).cast("string"), F.col(dept).cast("string"))


def split_series_id(col: str = "unique_id") -> dict[str, Column]:
    """Id back to (store, dept) integers."""
    parts = F.split(F.col(col), "_")
    return {"store": parts.getItem(0).cast("int"), "dept": parts.getItem(1).cast("int")}


def long_frame(df: DataFrame, target: str = "weekly_sales", with_holiday: bool = True) -> DataFrame:
    """B1 + B2 + B4: ``unique_id, ds, y [, is_holiday]``."""
    cols = [series_id().alias("unique_id"), F.col("date").alias("ds"), F.col(target).alias("y")]
    if with_holiday:
        cols.append(F.col("is_holiday"))
    return df.select(cols)


def first_n_series(df: DataFrame, n: int, keys: list[str] = S.KEYS) -> DataFrame:
    """Keep members of the first ``n`` series ids in key order (limit is the feature)."""
    ids = df.select(*keys).distinct().orderBy(*keys).limit(n)
    return df.join(ids, keys, "left_semi")


def below_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Keep rows with ``col`` strictly below its exact ``q`` quantile (scalar subquery
    over the distributed rank selection)."""
    from ..functions.quantiles import exact_quantile_value
    return df.filter(F.col(col) < exact_quantile_value(df, col, q))


def min_history(df: DataFrame, min_len: int, keys: list[str] = S.KEYS) -> DataFrame:
    """Keep series with at least ``min_len`` rows (count over the series window)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).filter(F.col("_n") >= min_len).drop("_n")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column with its NULL count (single pass, then unpivot)."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def nonzero_null_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns that still hold NULLs."""
    return null_counts(df, cols).filter(F.col("n_null") > 0)
