"""Mergeable quantile sketches (D8, D10): the large-scale form of exact quantiles.

A sketch of each small group (a store's week) is a partial aggregate of a few
kB that can be stored; sketches of larger groups are merged from it without
reading the rows again. Quantiles come within ``rank_error(k)`` of the asked
rank, whatever the number of values. Spark's KLL functions do the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch size; the error falls about in proportion.
K = 800


def rank_error(k: int = K) -> float:
    """Stated bound of a quantile's rank error, as a share of the values: twice the 99 % figure of the KLL sketch."""
    return 2 * 2.296 / k ** 0.9021


def sketch_by(df: DataFrame, col: str, by: list[str], k: int = K) -> DataFrame:
    """``by, sketch``: NULL values are left out; a group without values has an empty sketch."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Sketches of larger groups, from stored ones."""
    return (sketches.groupBy(*by) if by else sketches.groupBy()).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """``by, prob, value, n``; the value is NULL for an empty sketch."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    n = F.kll_sketch_get_n_double("sketch")
    got = sketches.select(*by, n.alias("n"), F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", asked)).alias("values"))
    rows = got.select(*by, "n", F.posexplode(F.coalesce("values", F.array_repeat(F.lit(None).cast("double"), len(probs)))).alias("i", "value"))
    return rows.select(*by, asked[F.col("i")].alias("prob"), "value", "n")
