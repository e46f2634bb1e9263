"""Forecast attachment and fallbacks.

Every test row gets exactly one prediction: joins are left joins from the
test frame on (store, dept[, date]); fallbacks are ``coalesce`` chains over
per-series and global means computed as aggregates (global mean is a
scalar subquery).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import schemas as S


def clip_lower(c: Column | str, lower: float = 0.0) -> Column:
    """Clip below at ``lower`` keeping NULL as NULL (``greatest`` would turn NULL into 0, T16)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col < lower, F.lit(lower)).otherwise(col)


def step_positions(test: DataFrame, date: str = "date") -> DataFrame:
    """Position (0-based) of each distinct test date among all test dates.

    Numbered over the distinct-date list, whose size is the forecast horizon.
    """
    d = test.select(date).distinct()
    steps = d.select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("step"))
    return steps


def lookup_predictions(test: DataFrame, preds: DataFrame, keys=S.KEYS, date: str = "date",
                       pred: str = "y_pred", default: float = 0.0) -> DataFrame:
    """C9 + K14: one prediction per test row; unseen keys get ``default`` and ``is_missing``."""
    p = preds.select(*keys, date, F.col(pred).alias("_p"))
    j = test.join(p, [*keys, date], "left")
    return j.withColumn("is_missing", F.col("_p").isNull()).withColumn(
        pred, F.coalesce(F.col("_p"), F.lit(default))).drop("_p")


def fallback_cascade(test: DataFrame, history: DataFrame, model_steps: DataFrame | None = None,
                     target: str = "weekly_sales", keys=S.KEYS, date: str = "date",
                     min_len: int = 52, clip: bool = True) -> DataFrame:
    """Model forecast if the series has ``min_len`` rows of history, else the
    series mean if it has any, else the global mean; ``source`` records which.

    ``model_steps`` holds ``keys, step, y_model``: forecasts by step position
    (T20: step = position of the test date among all test dates).
    """
    stats = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg(target).alias("_series_mean"))
    global_mean = history.agg(F.avg(target)).scalar()
    t = test.join(step_positions(test, date), date, "left").join(stats, keys, "left")
    if model_steps is not None:
        t = t.join(model_steps.select(*keys, "step", "y_model"), [*keys, "step"], "left")
    else:
        t = t.withColumn("y_model", F.lit(None).cast("double"))
    n = F.coalesce(F.col("_n"), F.lit(0))
    use_model = (n >= min_len) & F.col("y_model").isNotNull()
    pred = (F.when(use_model, F.col("y_model")).when(n > 0, F.col("_series_mean")).otherwise(global_mean))
    source = F.when(use_model, "model").when(n > 0, "series_mean").otherwise("global_mean")
    out = t.withColumn("y_pred", clip_lower(pred) if clip else pred).withColumn("source", source)
    return out.drop("_n", "_series_mean", "y_model")


def fallback_rate(cascade: DataFrame, keys=S.KEYS) -> DataFrame:
    """Series and the share forecast by a fallback."""
    per = cascade.groupBy(*keys).agg(F.max(F.col("source") != "model").alias("_fb"))
    return per.agg(F.count(F.lit(1)).alias("n_series"), F.count_if("_fb").alias("n_fallback"),
                   F.avg(F.col("_fb").cast("double")).alias("fallback_rate"))


def submission_frame(df: DataFrame, pred: str = "y_pred") -> DataFrame:
    """H5 + H3: ``Id = store_dept_yyyy-MM-dd`` and ``Weekly_Sales``."""
    rid = F.concat_ws("_", F.col("store").cast("string"), F.col("dept").cast("string"),
                      F.date_format("date", "yyyy-MM-dd"))
    return df.select(rid.alias("Id"), F.col(pred).cast("double").alias("Weekly_Sales"))
