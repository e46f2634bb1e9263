"""Frozen group averages for serving.

At fit time the dept/store means are snapshotted over all dates but the
last one (T8); at transform time rows look them up by key. Snapshots hold
one row per dept or store, a dimension-sized table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import schemas as S


def frozen_group_average(df: DataFrame, group: str, target: str = "weekly_sales", date: str = "date",
                         out: str | None = None) -> DataFrame:
    """Mean of per-date group means over all dates except the group's last.

    With a single date the snapshot is that date's mean.
    """
    return frozen_from_sums(date_sums(df, group, target, date), group, date, out)


def date_sums(df: DataFrame, group: str, target: str = "weekly_sales", date: str = "date") -> DataFrame:
    """The mergeable form of the snapshot: ``group, date, total, n`` (sum and count of the set targets)."""
    return (S.null_key_guard(df, [group, date]).groupBy(group, date)
            .agg(F.sum(target).alias("total"), F.count(target).alias("n")))


def add_sums(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Two tables of sums and counts as one."""
    return old.unionByName(new).groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def frozen_from_sums(sums: DataFrame, group: str, date: str = "date", out: str | None = None) -> DataFrame:
    """D19 from ``date_sums``."""
    out = out or f"{group}_avg_sales_expanding"
    per_date = sums.select(group, date, F.try_divide("total", F.col("n")).alias("_m"))
    w = Window.partitionBy(group)
    rn = F.row_number().over(w.orderBy(F.col(date).desc()))
    n = F.count(F.lit(1)).over(w)
    keep = per_date.select(group, "_m", rn.alias("_rn"), n.alias("_n")).filter(
        (F.col("_rn") > 1) | (F.col("_n") == 1))
    return keep.groupBy(group).agg(F.avg("_m").alias(out))


def lookup_snapshot(df: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Keyed lookup; missing key -> NULL (left join)."""
    return df.join(snapshot, key, "left")
