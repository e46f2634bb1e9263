"""Sparse trend changes per series (K21): an L1 penalty on the hinges of a piecewise-linear trend.

The ridge fit of ``additive`` keeps every possible change of slope; here only
those stay that the series asks for. Per (series, fold) one array of
cross-products of the design is summed over the train rows. Sweeping constant,
slope, seasonal terms and holidays out of it leaves the problem of the hinges
alone, which coordinate descent solves on a matrix of ``n_knots`` rows, all in
column functions: the rows are read once and never leave the executors' JVMs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linalg as LA
from ..functions.calendar import spread_holidays
from .additive import EPOCH, YEAR_DAYS

KEYS = ["store", "dept", "fold"]
#: Hinges stand in the first part of the history, as a change near its end cannot be told from noise.
HINGE_RANGE = 0.8


def trend_design(frame: DataFrame, calendar: DataFrame | None, fourier_order: int = 3, n_knots: int = 12) -> tuple[DataFrame, list[str], list[str]]:
    """``frame`` (rows of ``ar.fold_frame``) with design columns; (frame, free names, hinge names).

    ``u`` runs from 0 to 1 over a fold's train dates; hinge i is ``max(0, u - place)``; a holiday of ``calendar`` is
    one column, 1 on any day of its window.
    """
    days = F.datediff("date", F.lit(EPOCH).cast("date")).cast("double")
    w = Window.partitionBy(*KEYS)
    train_day = F.when(F.col("role") == "train", days)
    low, high = F.min(train_day).over(w), F.max(train_day).over(w)
    d = frame.withColumn("_low", low).withColumn("_span", F.greatest(high - low, F.lit(1.0)))
    u = (days - F.col("_low")) / F.col("_span")
    hinges = [f"hinge{i}" for i in range(1, n_knots + 1)]
    cols = [F.lit(1.0).alias("one"), u.alias("u")]
    free = ["one", "u"]
    for k in range(1, fourier_order + 1):
        angle = days * (2 * math.pi * k / YEAR_DAYS)
        cols += [F.sin(angle).alias(f"sin{k}"), F.cos(angle).alias(f"cos{k}")]
        free += [f"sin{k}", f"cos{k}"]
    d = d.select("*", *cols).select("*", *[F.greatest(F.lit(0.0), F.col("u") - place(i, n_knots)).alias(h) for i, h in enumerate(hinges, 1)])
    if calendar is not None:
        spread = spread_holidays(calendar)
        names = [r["name"] for r in calendar.select("name").distinct().orderBy("name").collect()]  # calendar-sized
        wide = spread.groupBy(F.col("ds").alias("date")).pivot("name", names).agg(F.lit(1.0))
        wide = wide.select("date", *[F.col(n).alias(f"holiday_{n}") for n in names])
        d = d.join(F.broadcast(wide), "date", "left").fillna(0.0, subset=[f"holiday_{n}" for n in names])
        free += [f"holiday_{n}" for n in names]
    return d, free, hinges


def place(i: int, n_knots: int) -> float:
    """Where hinge ``i`` of 1..n_knots stands on the scale of ``u``."""
    return HINGE_RANGE * i / (n_knots + 1)


def trend_products(design: DataFrame, names: list[str]) -> DataFrame:
    """``store, dept, fold, n, low, span, g``: cross-products of ``names`` and ``y`` over the train rows."""
    values = [F.col(n).cast("double") for n in [*names, "y"]]
    return design.groupBy(*KEYS).agg(LA.gram(values, F.col("role") == "train").alias("g"), F.first("_low").alias("low"), F.first("_span").alias("span"),
                                     F.count_if((F.col("role") == "train") & F.col("y").isNotNull()).alias("n"))


def sparse_trend(products: DataFrame, n_free: int, n_hinges: int, l1: float = 0.02, ridge: float = 1.0, rounds: int = 100, min_train: int = 30) -> DataFrame:
    """Least squares with ``ridge`` on seasonal and holiday terms and an L1 penalty on the hinges.

    The penalty is ``l1`` times the number of rows times the standard deviation
    of ``y``, so it does not depend on a series' size or length. Columns:
    keys, low, span, penalty, coefs (free terms, then hinges), error.
    """
    last = n_free + n_hinges
    g = F.col("g")
    eased = F.transform(g, lambda row, i: F.transform(row, lambda v, j: v + F.when((i == j) & (i >= 2) & (i < n_free), ridge).otherwise(0.0)))
    n = g[0][0]
    spread = F.sqrt(F.greatest((g[last][last] - g[0][last] * g[0][last] / n) / n, F.lit(0.0)))
    f = products.select(*KEYS, "low", "span", "n", (l1 * n * spread).alias("penalty"), eased.alias("e"))
    f = f.select(*KEYS, "low", "span", "n", "penalty", LA.regressed(F.col("e"), n_free).alias("m"))
    m = F.col("m")
    zeros = F.array(*[F.lit(0.0)] * n_hinges)

    def turn(b: Column, i: Column) -> Column:
        j = i % n_hinges
        row = m[n_free + j]
        own = row[n_free + j]
        rest = row[last] - LA.dot(F.slice(row, n_free + 1, n_hinges), b) + own * b[j]
        shrunk = F.signum(rest) * F.greatest(F.abs(rest) - F.col("penalty"), F.lit(0.0))
        return F.transform(b, lambda v, k: F.when(k == j, F.when(own > 1e-9, shrunk / own).otherwise(0.0)).otherwise(v))

    hinges = F.aggregate(F.sequence(F.lit(0), F.lit(rounds * n_hinges - 1)), zeros, turn)
    error = F.when(F.col("n") < min_train, F.lit("fold guard: train < 30 rows")).when(m[0][last].isNull(), F.lit("no unique fit"))
    f = f.select(*KEYS, "low", "span", "penalty", "m", error.alias("error")).select("*", F.when(F.col("error").isNull(), hinges).alias("b"))
    free = F.transform(F.sequence(F.lit(0), F.lit(n_free - 1)), lambda i: m[i][last] - LA.dot(F.slice(m[i], n_free + 1, n_hinges), F.col("b")))
    return f.select(*KEYS, "low", "span", "penalty", "b", "error", F.when(F.col("error").isNull(), free).alias("a")).select(
        *KEYS, "low", "span", "penalty", F.concat("a", "b").alias("coefs"), "error")


def change_points(fits: DataFrame, n_free: int, n_hinges: int) -> DataFrame:
    """``store, dept, fold, date, slope_change``: the changes that stayed, slopes per year."""
    b = F.slice("coefs", n_free + 1, n_hinges)
    e = fits.select(*KEYS, "low", "span", F.posexplode_outer(b).alias("i", "change")).filter(F.col("change") != 0)
    day = F.col("low") + F.col("span") * (HINGE_RANGE * (F.col("i") + 1) / (n_hinges + 1))
    return e.select(*KEYS, F.date_add(F.lit(EPOCH).cast("date"), F.round(day).cast("int")).alias("date"), (F.col("change") / F.col("span") * YEAR_DAYS).alias("slope_change"))


def evaluate_sparse(frame: DataFrame, calendar: DataFrame | None, fourier_order: int = 3, n_knots: int = 12, l1: float = 0.02) -> DataFrame:
    """K21 + K25: validation predictions per (series, fold); schema as ``additive.evaluate_additive``."""
    design, free, hinges = trend_design(frame, calendar, fourier_order, n_knots)
    fits = sparse_trend(trend_products(design, [*free, *hinges]), len(free), len(hinges), l1).select(*KEYS, "coefs", "error")
    value = LA.dot(F.array(*[F.col(c).cast("double") for c in [*free, *hinges]]), F.col("coefs"))
    return design.filter(F.col("role") == "val").join(fits, KEYS).select(
        *KEYS, "date", "y", "is_holiday", F.when(F.col("error").isNull(), value).alias("y_pred"), "error")
