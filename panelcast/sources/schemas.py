"""Explicit schemas (no inference) and source guards.

Column names are snake case throughout the library: ``store, dept, date,
weekly_sales, is_holiday``. Readers of the original CSV layout rename once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["store", "dept"]
PANEL_KEYS = ["store", "dept", "date"]
MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]

TRAIN_CSV = T.StructType([
    T.StructField("Store", T.IntegerType(), False),
    T.StructField("Dept", T.IntegerType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Weekly_Sales", T.DoubleType(), False),
    T.StructField("IsHoliday", T.BooleanType(), False),
])

TEST_CSV = T.StructType([f for f in TRAIN_CSV.fields if f.name != "Weekly_Sales"])

FEATURES_CSV = T.StructType(
    [T.StructField("Store", T.IntegerType(), False),
     T.StructField("Date", T.DateType(), False),
     T.StructField("Temperature", T.DoubleType(), True),
     T.StructField("Fuel_Price", T.DoubleType(), True)]
    + [T.StructField(f"MarkDown{i}", T.DoubleType(), True) for i in range(1, 6)]
    + [T.StructField("CPI", T.DoubleType(), True),
       T.StructField("Unemployment", T.DoubleType(), True),
       T.StructField("IsHoliday", T.BooleanType(), False)]
)

STORES_CSV = T.StructType([
    T.StructField("Store", T.IntegerType(), False),
    T.StructField("Type", T.StringType(), False),
    T.StructField("Size", T.IntegerType(), False),
])

HOLIDAY = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("lower_window", T.IntegerType(), False),
    T.StructField("upper_window", T.IntegerType(), False),
])

OUTPUT = T.StructType([
    T.StructField("Id", T.StringType(), False),
    T.StructField("Weekly_Sales", T.DoubleType(), False),
])

# CSV header -> library column name (fixed values of the original layout)
RENAME = {
    "Store": "store", "Dept": "dept", "Date": "date", "Weekly_Sales": "weekly_sales",
    "IsHoliday": "is_holiday", "Temperature": "temperature", "Fuel_Price": "fuel_price",
    "MarkDown1": "markdown1", "MarkDown2": "markdown2", "MarkDown3": "markdown3",
    "MarkDown4": "markdown4", "MarkDown5": "markdown5", "CPI": "cpi",
    "Unemployment": "unemployment", "Type": "type", "Size": "size",
}


def snake_case(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).alias(RENAME.get(c, c)) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column (rule: never carry NaN)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def null_key_guard(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose join/group keys are NULL (pandas groupby drops them, T15).

    Keys are non-null by contract (T14); this keeps a violated contract from
    matching NULL to NULL the way pandas merge would.
    """
    cond: Column | None = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def duplicate_keys(df: DataFrame, keys: list[str] = PANEL_KEYS) -> DataFrame:
    """Panel contract: one row per (store, dept, date). Series windows partition by
    (store, dept), so a series is bounded by its number of weeks only if keys are
    unique; aggregate raw rows first (e.g. ``groupBy(*keys).agg(sum(...))``).

    Returns the duplicated keys with their multiplicity (empty when the contract holds).
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
