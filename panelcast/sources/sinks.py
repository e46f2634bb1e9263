"""Sinks: forecast CSV, importances, run log (A3-A5). Model persistence
lives with the models (``pyspark.ml`` writers).

Writes are distributed (one file per task); nothing is coalesced to a single
task or collected to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = "run string, kind string, key string, value double, ts timestamp"


def write_forecast(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: ``Id, Weekly_Sales`` CSV with a header, no index column."""
    df.select("Id", "Weekly_Sales").write.mode(mode).option("header", True).csv(path)


def write_importances(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: feature importance table as CSV."""
    df.write.mode(mode).option("header", True).csv(path)


def log_metrics(spark: SparkSession, path: str, run: str, kind: str, values: dict[str, float]) -> DataFrame:
    """A5: append params/metrics of one run to an append-only parquet log."""
    ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(run, kind, k, float(v), ts) for k, v in values.items()]
    df = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    df.write.mode("append").parquet(path)
    return df


def log_frame(df: DataFrame, path: str, run: str, kind: str, key_col: str, value_col: str) -> None:
    """A5: append a distributed metric frame (per-trial, per-series ...) to the log."""
    (df.select(F.lit(run).alias("run"), F.lit(kind).alias("kind"), F.col(key_col).cast("string").alias("key"),
               F.col(value_col).cast("double").alias("value"), F.current_timestamp().alias("ts"))
     .write.mode("append").parquet(path))


def log_runs(df: DataFrame, path: str, run_col: str, columns: dict[str, str], kind: str = "metric") -> None:
    """A5: append one value per row and column; ``columns`` gives each column its key, ``run_col`` names the run."""
    long = df.select(F.col(run_col).cast("string").alias("run"), *[F.col(c).cast("double").alias(k) for c, k in columns.items()])
    (long.unpivot(["run"], list(columns.values()), "key", "value")
     .select("run", F.lit(kind).alias("kind"), "key", "value", F.current_timestamp().alias("ts")).write.mode("append").parquet(path))


def log_params(df: DataFrame, path: str, run_col: str, params_col: str) -> None:
    """A5: append every parameter of a run, given as a JSON object of numbers (or numbers as text)."""
    (df.select(F.col(run_col).cast("string").alias("run"), F.explode(F.from_json(params_col, "map<string,string>")).alias("key", "v"))
     .select("run", F.lit("param").alias("kind"), "key", F.expr("try_cast(v AS double)").alias("value"), F.current_timestamp().alias("ts"))
     .write.mode("append").parquet(path))


def run_summary(spark: SparkSession, path: str, kind: str = "metric", keys: list[str] | None = None) -> DataFrame:
    """A5 summary: one row per run, one column per key (latest value).

    ``keys`` names the columns; without it the log is read once more for its distinct keys.
    """
    log = spark.read.parquet(path).filter(F.col("kind") == kind)
    grouped = log.groupBy("run")
    return (grouped.pivot("key", keys) if keys else grouped.pivot("key")).agg(F.max_by("value", "ts"))
