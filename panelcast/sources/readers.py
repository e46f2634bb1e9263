"""Sources: the original CSV layout (A1) and columnar parquet tables (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas as S


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", True)
            .option("dateFormat", "yyyy-MM-dd")
            .option("nullValue", "NA")
            .option("mode", "FAILFAST")
            .csv(path))


def load_raw_data(spark: SparkSession, data_dir: str = "data") -> tuple[DataFrame, ...]:
    """A1: train, test, features, stores with declared schemas, snake-case names, NaN -> NULL."""
    parts = [("train", S.TRAIN_CSV), ("test", S.TEST_CSV),
             ("features", S.FEATURES_CSV), ("stores", S.STORES_CSV)]
    return tuple(S.nan_to_null(S.snake_case(read_csv(spark, f"{data_dir}/{name}.csv", sch)))
                 for name, sch in parts)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A2: one driver parquet table (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
