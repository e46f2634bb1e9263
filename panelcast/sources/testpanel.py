"""Weekly retail-shaped panel derived from the driver's star-schema tables.

The reference works on a (store, dept, week) sales panel plus store-week
features and a store dimension. No driver table has that layout, so it is
derived here, with the same recipe written as SQL CTEs in ``plans.oracle``:

* ``date``          Friday of the Monday-based week of ``l_shipdate``
* ``store``         supplier nation (``grain='nation'``, 150 gappy series at
                    sf0.01), its region (``'region'``, 30 dense series) or the
                    nation with brand as dept (``'brand'``, 625 series)
* ``dept``          part type code 1..6 (brand number 1..55 for ``'brand'``)
* ``weekly_sales``  exact sum of cents / 100 (order-independent double)
* ``is_holiday``    Friday in ISO week 6, 36, 47 or 52

Scale: the big input is ``lineitem``. It joins its dimensions, and one
aggregate with map-side partial sums reduces it to (store, dept, week); a
sum before the joins would reduce nothing. The dimension joins carry no hints:
Catalyst/AQE broadcast ``part`` / ``supplier`` only while their measured
size is under the broadcast threshold and fall back to sort-merge joins
(with AQE skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import HOLIDAY_ISO_WEEKS, friday_of_week
from .readers import read_table

# Part type -> department code.
DEPT_CODES: list[tuple[str, int]] = [
    ("ECONOMY", 1), ("LARGE", 2), ("MEDIUM", 3), ("PROMO", 4), ("SMALL", 5), ("STANDARD", 6),
]
# Order priority -> markdown column number.
PRIORITY_MARKDOWN: list[tuple[str, int]] = [
    ("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5),
]
TEST_WEEKS = 39
# The one (store, dept) removed from train so it appears only in test.
UNSEEN_SERIES = (0, 1)

GRAINS = ("nation", "region", "brand")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def dept_code(c: str = "p_type") -> Column:
    e = None
    for name, code in DEPT_CODES:
        e = F.when(F.col(c) == name, F.lit(code)) if e is None else e.when(F.col(c) == name, F.lit(code))
    return e.cast("int")


def is_holiday_week(date: Column | str = "date") -> Column:
    return F.weekofyear(date).isin([w for _, w in HOLIDAY_ISO_WEEKS])


def _supplier_store(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if grain == "region":
        nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        return (supp.join(nation, supp.s_nationkey == nation.n_nationkey)
                .select("s_suppkey", F.col("n_regionkey").alias("store")))
    return supp.select("s_suppkey", F.col("s_nationkey").alias("store"))


def _part_dept(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    if grain == "brand":
        d = F.element_at(F.split("p_brand", "#"), 2).cast("int")
    else:
        d = dept_code("p_type")
    return part.select("p_partkey", d.alias("dept"))


def sales_panel(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Panel ``(store int, dept int, date date, weekly_sales double, is_holiday boolean)``.

    ``lineitem`` joins its two dimensions, which Spark broadcasts while they are
    small, and one aggregate with map-side partial sums of exact cents reduces
    it to (store, dept, week): a hot part or supplier sends one row per task
    and week. (A sum per part, supplier and week before the joins reduces
    nothing: those triples are almost unique.)
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    li = read_table(spark, sf_dir, "lineitem")
    lines = li.select("l_partkey", "l_suppkey", friday_of_week("l_shipdate").alias("date"), cents("l_extendedprice").alias("cents"))
    part = _part_dept(spark, sf_dir, grain)
    supp = _supplier_store(spark, sf_dir, grain)
    joined = (lines.join(part, lines.l_partkey == part.p_partkey)
              .join(supp, lines.l_suppkey == supp.s_suppkey))
    return (joined.groupBy("store", "dept", "date")
            .agg((F.sum("cents").cast("double") / F.lit(100.0)).alias("weekly_sales"))
            .withColumn("is_holiday", is_holiday_week("date")))


def features_table(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Store-week exogenous table with natural NULLs (sparse markdowns, early end).

    ``temperature`` mean order value, ``fuel_price`` order count, ``cpi`` mean
    customer balance, ``unemployment`` share of finished orders,
    ``markdown1..5`` order value per priority. ``is_holiday`` is carried so the
    merge has a duplicate column to drop (B3). ``orders`` joins customers and one
    aggregate with partial exact integer sums reduces it.
    """
    orders = read_table(spark, sf_dir, "orders")
    lines = orders.select(
        "o_custkey", friday_of_week("o_orderdate").alias("date"), cents("o_totalprice").alias("value_cents"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished"),
        *[F.when(F.col("o_orderpriority") == prio, cents("o_totalprice")).alias(f"md{k}") for prio, k in PRIORITY_MARKDOWN])
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    if grain == "region":
        nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        cust = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
                .select("c_custkey", "c_acctbal", F.col("n_regionkey").alias("store")))
    else:
        cust = cust.select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("store"))
    j = lines.join(cust, lines.o_custkey == cust.c_custkey)
    n = F.count(F.lit(1))
    aggs = [
        (F.sum("value_cents").cast("double") / (F.lit(100.0) * n)).alias("temperature"),
        n.cast("double").alias("fuel_price"),
        (F.sum(cents("c_acctbal")).cast("double") / (F.lit(100.0) * n)).alias("cpi"),
        (F.sum("finished").cast("double") / n).alias("unemployment"),
    ]
    for _, k in PRIORITY_MARKDOWN:
        aggs.append((F.sum(f"md{k}").cast("double") / F.lit(100.0)).alias(f"markdown{k}"))
    return (j.groupBy("store", "date").agg(*aggs)
            .withColumn("is_holiday", is_holiday_week("date")))


def stores_table(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Store dimension ``(store, type, size)``: type = region name, size = supplier count."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    key = "n_regionkey" if grain == "region" else "n_nationkey"
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey)
    counts = supp.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_supp"))
    return (nr.join(counts, nr.n_nationkey == counts.s_nationkey, "left")
            .groupBy(F.col(key).alias("store"))
            .agg(F.min("r_name").alias("type"),
                 F.coalesce(F.sum("n_supp"), F.lit(0)).cast("int").alias("size")))


def train_test_split(panel: DataFrame, test_weeks: int = TEST_WEEKS,
                     unseen: tuple[int, int] | None = UNSEEN_SERIES) -> tuple[DataFrame, DataFrame]:
    """Last ``test_weeks`` Fridays become the test frame (target withheld).

    One (store, dept) is removed from train so the test frame has a series
    the train frame never saw.
    """
    # Scalar subquery: partial max per task, one tiny final; no global window.
    cut = F.date_sub(panel.agg(F.max("date")).scalar(), 7 * test_weeks)
    t = panel.withColumn("_cut", cut)
    train = t.filter(F.col("date") <= F.col("_cut")).drop("_cut")
    if unseen is not None:
        train = train.filter(~((F.col("store") == unseen[0]) & (F.col("dept") == unseen[1])))
    test = t.filter(F.col("date") > F.col("_cut")).drop("_cut", "weekly_sales")
    return train, test

