"""Holiday-weighted MAE as a Column expression.

``wmae_expr`` is an ordinary aggregate expression, usable inside any
``agg``: partial sums combine map-side, so the metric over billions of rows
is one small shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLIDAY_WEIGHT = 5  # fixed value: weight of holiday weeks


def holiday_weight(is_holiday: str = "is_holiday") -> Column:
    """H6: 5 for holiday rows, 1 otherwise; a missing flag counts as holiday."""
    h = F.col(is_holiday)
    return F.when(h.isNull() | h, F.lit(HOLIDAY_WEIGHT)).otherwise(F.lit(1))


def wmae_expr(y: str = "y", p: str = "y_pred", is_holiday: str = "is_holiday") -> Column:
    """sum(w*|y-p|)/sum(w); NULL if any actual or prediction is missing."""
    w = holiday_weight(is_holiday)
    err = F.abs(F.col(y) - F.col(p))
    value = F.sum(w * err) / F.sum(w)
    return F.when(F.count(F.lit(1)) == F.count(err), value)


def wmae_by(df: DataFrame, by: list[str], y="y", p="y_pred", is_holiday="is_holiday",
            out: str = "wmae") -> DataFrame:
    """WMAE per group (series, fold, model ...)."""
    return df.groupBy(*by).agg(wmae_expr(y, p, is_holiday).alias(out), F.count(F.lit(1)).alias("n_rows"))


def mean_and_median(scores: DataFrame, col: str = "wmae", by: list[str] | None = None) -> DataFrame:
    """Mean and median of per-series scores (exact median by rank selection)."""
    from .quantiles import exact_quantiles
    by = list(by or [])
    if by:
        m = scores.groupBy(*by).agg(F.avg(col).alias(f"mean_{col}"))
        med = exact_quantiles(scores, col, [0.5], by=by).select(*by, F.col("value").alias(f"median_{col}"))
        return m.join(med, by, "left")
    med = exact_quantiles(scores, col, [0.5]).select("value").scalar()
    return scores.agg(F.avg(col).alias(f"mean_{col}"), med.alias(f"median_{col}"))


def compare_models(scores: DataFrame, by: str, model: str, value: str, baseline: str, candidate: str) -> DataFrame:
    """One row per ``by`` with one column per model and the improvement in percent.

    ``try_divide`` keeps ANSI mode from failing on a zero baseline (H15).
    """
    wide = scores.groupBy(by).pivot(model, [baseline, candidate]).agg(F.first(value))
    return wide.withColumn(
        "improvement_pct",
        F.try_divide(F.col(baseline) - F.col(candidate), F.col(baseline)) * 100)
