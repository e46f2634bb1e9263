"""Least squares in column functions: cross-product sums, the sweep operator, quadratic forms.

A regression of the last of k values on the others needs only the k x k sums of
their products, one aggregate row per group. ``swept`` then solves it inside
array functions: after sweeping the pivots of the regressors, the last row
holds the coefficients, its last entry the residual sum of squares, and the
swept block minus the inverse cross-products. Pivots swept one after another
pass through the nested regressions on the first, the first two, ... values.

Lambdas only read lambda variables and grouped attributes, so nothing is
evaluated twice. A pivot that is not positive beyond ``TOLERANCE`` of its
original diagonal gives NULLs, as do empty sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-11


def gram(values: list[Column], keep: Column | None = None) -> Column:
    """Aggregate expression: ``array<array<double>>`` of the sums of products of ``values`` over rows where all are set (and ``keep`` holds)."""
    whole = keep if keep is not None else F.lit(True)
    for v in values:
        whole = whole & v.isNotNull()
    sums = {}
    for i, a in enumerate(values):
        for j, b in enumerate(values[i:], i):
            sums[i, j] = sums[j, i] = F.sum(F.when(whole, a * b))
    return F.array(*[F.array(*[sums[i, j].cast("double") for j in range(len(values))]) for i in range(len(values))])


def swept(a: Column, k: Column, diagonal: Column | None = None) -> Column:
    """Matrix ``a`` after sweeping pivot ``k`` (from 0); ``diagonal`` is the original one that the tolerance refers to."""
    pivot = a[k][k]
    floor = F.lit(0.0) if diagonal is None else diagonal[k] * TOLERANCE
    d = F.when(pivot > floor, pivot)
    return F.transform(a, lambda row, i: F.transform(row, lambda v, j: (
        F.when((i == k) & (j == k), -1.0 / d).when((i == k) | (j == k), v / d).otherwise(v - row[k] * a[k][j] / d))))


def diagonal_of(a: Column) -> Column:
    return F.transform(a, lambda row, i: row[i])


def regressed(g: Column, regressors: int) -> Column:
    """``g`` with its first ``regressors`` pivots swept: coefficients are ``[i][regressors]``, the residual sum ``[regressors][regressors]``."""
    start = F.struct(g.alias("m"), diagonal_of(g).alias("d"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(regressors - 1)), start,
                       lambda acc, k: F.struct(swept(acc["m"], k, acc["d"]).alias("m"), acc["d"].alias("d")), lambda acc: acc["m"])


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def quadratic(m: Column, g: Column) -> Column:
    """``m g m'`` for an array of row maps ``m`` and a symmetric ``g``: the cross-products of the mapped values."""
    half = F.transform(m, lambda row: F.transform(g, lambda column: dot(row, column)))
    return F.transform(half, lambda left: F.transform(m, lambda row: dot(left, row)))
