"""Audits and summaries.

All are single-pass aggregates (partial aggregation map-side, one small
shuffle) or scalar subqueries; quantiles use distributed rank selection
(``functions.quantiles``); nothing data-sized is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..sources import schemas as S


def summary_by(df: DataFrame, by: list[str], col: str, stats=("mean", "median", "count")) -> DataFrame:
    """Mean / median / count (and min / max) of ``col`` per group.

    The median comes from ``exact_quantiles`` (no single-task value buffer).
    """
    fns = {"mean": F.avg, "count": F.count, "min": F.min, "max": F.max}
    out = df.groupBy(*by).agg(*[fns[s](col).alias(f"{s}_{col}") for s in stats if s != "median"])
    if "median" in stats:
        med = exact_quantiles(df, col, [0.5], by=by).select(*by, F.col("value").alias(f"median_{col}"))
        out = out.join(med, by, "left")
    return out.select(*by, *[f"{s}_{col}" for s in stats])


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def dtypes(df: DataFrame) -> DataFrame:
    """Per column its position, Spark type and non-null count (one pass, then unpivot)."""
    spark = df.sparkSession
    meta = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(df.dtypes)],
                                 "position int, column string, type string")
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column", "n_non_null")
    return meta.join(F.broadcast(counts), "column")  # one row per column on both sides


def date_range(df: DataFrame, date: str = "date") -> DataFrame:
    """first/last date, span in days and weeks, distinct dates, NULL dates."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                  F.datediff(F.max(date), F.min(date)).alias("span_days"),
                  (F.datediff(F.max(date), F.min(date)) / 7 + 1).cast("int").alias("span_weeks"),
                  F.count_distinct(date).alias("n_dates"),
                  F.count_if(F.col(date).isNull()).alias("n_null_dates"))


def split_date_audit(train: DataFrame, test: DataFrame, features: DataFrame, date: str = "date",
                     null_col: str = "cpi", nulls_in: DataFrame | None = None) -> DataFrame:
    """Date ranges of train / test / features, the gap in days between the last
    train date and the first test date, and the date range of rows missing ``null_col``
    (looked up in ``nulls_in``, default the feature table).

    Every value is a scalar subquery (partial min/max per task); one output row.
    """
    def rng(df):
        return df.agg(F.min(date)).scalar(), df.agg(F.max(date)).scalar()
    tr, te, fe = rng(train), rng(test), rng(features)
    nl = rng((features if nulls_in is None else nulls_in).filter(F.col(null_col).isNull()))
    spark = train.sparkSession
    return spark.range(1).select(
        tr[0].alias("train_first"), tr[1].alias("train_last"), te[0].alias("test_first"),
        te[1].alias("test_last"), fe[0].alias("features_first"), fe[1].alias("features_last"),
        F.datediff(te[0], tr[1]).alias("gap_days"),
        nl[0].alias(f"{null_col}_null_first"), nl[1].alias(f"{null_col}_null_last"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    qv = {p: q.filter(F.col("prob") == p).select("value").scalar() for p in (0.25, 0.5, 0.75)}
    return df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).alias("min"), qv[0.25].alias("p25"), qv[0.5].alias("p50"), qv[0.75].alias("p75"),
                  F.max(col).alias("max"))


def negatives(df: DataFrame, col: str = "weekly_sales") -> DataFrame:
    """Count of negative values and the minimum."""
    return df.agg(F.count_if(F.col(col) < 0).alias("n_negative"), F.min(col).alias(f"min_{col}"))


def quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Exact quantile by distributed rank selection (``approx_percentile`` is the
    cheaper approximate alternative)."""
    return exact_quantiles(df, col, [q]).select(F.col("value").alias(f"q{int(round(q * 100))}"))


def histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last bin.

    Bounds are scalar subqueries; the count is one aggregate over the bin id.
    """
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    width = hi - lo
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col(col) - lo) * bins / width) + 1, F.lit(bins))).cast("int")
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_start", lo + (F.col("bin") - 1) * width / bins))


def distinct_series(df: DataFrame, keys=S.KEYS) -> DataFrame:
    """Number of distinct series."""
    return df.agg(F.count_distinct(*keys).alias("n_series"))


def series_lengths(df: DataFrame, keys=S.KEYS, date: str = "date") -> DataFrame:
    """Rows per series and whether all series have the same length."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_series"), F.min("n").alias("min_len"),
                   F.max("n").alias("max_len"), (F.count_distinct("n") == 1).alias("equal_length"))


def gap_stats(df: DataFrame, keys=S.KEYS, date: str = "date", short: int = 52) -> DataFrame:
    """Per series missing inner weeks and short-history flag."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_weeks"),
        ((F.datediff(F.max(date), F.min(date)) / 7).cast("int") + 1 - F.count(F.lit(1))).alias("n_missing"),
    ).withColumn("is_short", F.col("n_weeks") < short)


def gap_summary(df: DataFrame, keys=S.KEYS, date: str = "date", short: int = 52) -> DataFrame:
    """D23 summary: series, series with gaps, short series."""
    g = gap_stats(df, keys, date, short)
    return g.agg(F.count(F.lit(1)).alias("n_series"),
                 F.count_if(F.col("n_missing") > 0).alias("n_with_gaps"),
                 F.count_if("is_short").alias("n_short"),
                 F.sum("n_missing").alias("n_missing_weeks"))


def coverage(train: DataFrame, test: DataFrame, keys=S.KEYS) -> DataFrame:
    """Series only in test, only in train, and in both (anti/semi joins on distinct ids)."""
    a = train.select(*keys).distinct()
    b = test.select(*keys).distinct()
    only_test = b.join(a, keys, "left_anti").agg(F.count(F.lit(1)).alias("n_only_test"))
    only_train = a.join(b, keys, "left_anti").agg(F.count(F.lit(1)).alias("n_only_train"))
    both = b.join(a, keys, "left_semi").agg(F.count(F.lit(1)).alias("n_both"))
    return only_test.select("n_only_test", F.lit(only_train.scalar()).alias("n_only_train"),
                            F.lit(both.scalar()).alias("n_both"))


def series_only_in(left: DataFrame, right: DataFrame, keys=S.KEYS) -> DataFrame:
    """G1: the ids of ``left`` absent from ``right``."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """F1 + F2: ordered preview (TakeOrderedAndProject; the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, n: int, col: str, ascending: bool = False, tie: list[str] | None = None) -> DataFrame:
    """top ``n`` by ``col`` with explicit tie-break columns."""
    o = [F.col(col).asc() if ascending else F.col(col).desc()] + [F.col(c) for c in (tie or [])]
    return df.orderBy(*o).limit(n)

