"""Walk-forward folds and holdouts.

A fold table has one row per fold (``fold, val_start, val_end``); its size
is ``n_splits``, a parameter, so broadcasting it is safe at any data size.
Fold bounds come from scalar subqueries (partial min/max per task), never
from a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import schemas as S


def walk_forward_folds(df: DataFrame, date: str = "date", n_splits: int = 3,
                       horizon_weeks: int = 38) -> DataFrame:
    """Fold table, oldest fold first.

    Fold ``i`` back from the last date validates on [end - 7h, end] (closed
    at both ends, T10) with end = last - 7h*i. A fold whose train part
    (dates < val_start) would be empty is omitted.
    """
    spark: SparkSession = df.sparkSession
    last = df.agg(F.max(date)).scalar()
    first = df.agg(F.min(date)).scalar()
    days = 7 * horizon_weeks
    base = (spark.range(n_splits).select(F.col("id").cast("int").alias("i"))
            .select("i", F.date_sub(last, F.col("i") * days).alias("val_end"))
            .withColumn("val_start", F.date_sub("val_end", days))
            .filter(F.col("val_start") > first))
    # kept folds are i = 0..m-1; oldest first means fold = m-1-i
    m = base.agg(F.count(F.lit(1))).scalar()
    return base.select((m - 1 - F.col("i")).cast("int").alias("fold"), "val_start", "val_end")


def fold_cutoffs(df: DataFrame, date: str = "date", n_splits: int = 3, horizon_weeks: int = 13) -> DataFrame:
    """Half-open fold cutoffs: train < cutoff, validate [cutoff, cutoff + 7h)."""
    return (walk_forward_folds(df, date, n_splits, horizon_weeks)
            .select("fold", F.date_add("val_start", 7).alias("cutoff"),
                    F.date_add("val_end", 7).alias("val_end_exclusive")))


def assign_folds(df: DataFrame, folds: DataFrame, date: str = "date") -> DataFrame:
    """C14 + B12: rows x folds with ``role`` train (date < val_start) or val (in range).

    Each row appears once per fold it belongs to (at most ``n_splits`` times);
    the fold table is broadcast because its size is the ``n_splits`` parameter.
    """
    f = F.broadcast(folds)
    j = df.join(f, F.col(date) <= F.col("val_end"), "inner")
    return j.withColumn("role", F.when(F.col(date) < F.col("val_start"), "train").otherwise("val"))


def fold_summary(assigned: DataFrame, date: str = "date") -> DataFrame:
    """Per fold: train/val row counts and date ranges."""
    tr = F.col("role") == "train"
    return assigned.groupBy("fold", "val_start", "val_end").agg(
        F.count_if(tr).alias("n_train"), F.count_if(~tr).alias("n_val"),
        F.min(F.when(tr, F.col(date))).alias("train_start"),
        F.max(F.when(tr, F.col(date))).alias("train_end"),
        F.count_distinct(F.when(~tr, F.col(date))).alias("n_val_dates"))


def holdout_last_weeks(df: DataFrame, weeks: int, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Global holdout: val = dates after last - 7*weeks."""
    cut = F.date_sub(df.agg(F.max(date)).scalar(), 7 * weeks)
    return df.filter(F.col(date) <= cut), df.filter(F.col(date) > cut)


def series_fold_bounds(df: DataFrame, keys=S.KEYS, date: str = "date", n_splits: int = 3,
                       horizon_weeks: int = 13) -> DataFrame:
    """J1 per series: ``keys, fold, val_start, val_end`` from each series' own first and
    last date (the per-series call of the walk-forward split), oldest fold first.

    One aggregate per series, then array expressions on that row: the number of
    kept folds is computed in place, no window and no join.
    """
    days = 7 * horizon_weeks
    b = df.groupBy(*keys).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    idx = F.sequence(F.lit(0), F.lit(n_splits - 1))
    kept = F.filter(idx, lambda i: F.date_sub(F.col("_last"), (i + 1) * days) > F.col("_first"))
    e = b.select(*keys, "_last", F.size(kept).alias("_m"), F.explode(kept).alias("_i"))
    return e.select(*keys, (F.col("_m") - 1 - F.col("_i")).cast("int").alias("fold"),
                    F.date_sub("_last", (F.col("_i") + 1) * days).alias("val_start"),
                    F.date_sub("_last", F.col("_i") * days).alias("val_end"))


def per_series_folds(df: DataFrame, keys=S.KEYS, date: str = "date", n_splits: int = 3,
                     horizon_weeks: int = 13, min_train: int = 30) -> DataFrame:
    """J1 per series + B14: folds from each series' own last date.

    Returns ``keys, fold, val_start, val_end, n_train, n_val`` for folds with
    at least ``min_train`` train rows and a non-empty validation part.
    """
    folds = series_fold_bounds(df, keys, date, n_splits, horizon_weeks)
    j = df.select(*keys, date).join(folds, keys).filter(F.col(date) <= F.col("val_end"))
    counts = j.groupBy(*keys, "fold", "val_start", "val_end").agg(
        F.count_if(F.col(date) < F.col("val_start")).alias("n_train"),
        F.count_if(F.col(date) >= F.col("val_start")).alias("n_val"))
    return counts.filter((F.col("n_train") >= min_train) & (F.col("n_val") > 0))
