"""Nearest-match join of two tables (C10): each left row with the closest right row in time.

Both sides are put into one stream per key and time bucket, where the last
match before and the first one after a row are window functions; the right
side is a table of any size, not a list in the plan. A hot key does not fill
one task: its rows are split by ``bucket_days``, and the right rows nearest to
a bucket from outside are carried into it from one small row per (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("nearest", "backward", "forward")


def nearest_match(left: DataFrame, right: DataFrame, by: list[str], left_date: str, right_date: str, take: list[str],
                  tie: str | None = None, direction: str = "nearest", tolerance_days: int | None = None,
                  bucket_days: int = 364) -> DataFrame:
    """All left columns, the right columns ``take``, and ``days``: the right date minus the left one.

    ``direction``: ``backward`` matches dates up to the left one, ``forward``
    from it on, ``nearest`` either. Equal distances go to the smaller ``tie``
    (a right column; default: the earlier date), as do right rows of one date,
    then to the smaller ``take``. Left rows without a match (none within ``tolerance_days``,
    a null date or key) keep their row with NULLs; right rows with a null date or key match nothing.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    clash = [c for c in [*take, "days"] if c in left.columns]
    if clash:
        raise ValueError(f"columns of the result on both sides: {clash}")
    keys = [f"_k{i}" for i in range(len(by))]
    key_of = lambda df: [df[c].alias(k) for c, k in zip(by, keys)]
    order = F.col(tie) if tie else F.lit(0)
    r = right.select(*key_of(right), F.unix_date(right_date).alias("_t"), order.alias("_o"), F.struct(*take).alias("_take"))
    r = r.filter(F.col("_t").isNotNull())
    for k in keys:
        r = r.filter(F.col(k).isNotNull())
    # one right row a date: the first in tie order
    r = r.groupBy(*keys, "_t").agg(F.min(F.struct("_o", "_take")).alias("_m"))
    bucket = F.floor(F.col("_t") / bucket_days)
    match = F.struct("_t", "_m._o", "_m._take")
    none = F.lit(None).cast(r.select(match.alias("m")).schema["m"].dataType)
    right_rows = r.select(*keys, bucket.alias("_b"), "_t", match.alias("_r"), F.lit(None).cast(left.select(F.struct("*").alias("l")).schema["l"].dataType).alias("_l"))
    left_rows = left.select(*key_of(left), F.unix_date(left_date).alias("_t"), F.struct(*left.columns).alias("_l"))
    left_rows = left_rows.select(*keys, bucket.alias("_b"), "_t", none.alias("_r"), "_l")
    rows = left_rows.unionByName(right_rows)

    # the nearest right rows outside each bucket, from one row per (key, bucket)
    edges = rows.groupBy(*keys, "_b").agg(F.min("_r").alias("_first"), F.max("_r").alias("_last"))
    over = Window.partitionBy(*keys).orderBy("_b")
    before = F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing))
    carried = (edges.select(*keys, "_b", before.alias("_before"), after.alias("_after"))
               .select(*keys, "_b", F.explode(F.array("_before", "_after")).alias("_r")).filter(F.col("_r").isNotNull())
               .select(*keys, "_b", F.col("_r._t").alias("_t"), "_r", F.lit(None).cast(rows.schema["_l"].dataType).alias("_l")))
    stream = rows.unionByName(carried).withColumn("_is_left", F.col("_l").isNotNull())
    up = Window.partitionBy(*keys, "_b").orderBy("_t", "_is_left").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys, "_b").orderBy(F.desc("_t"), "_is_left").rowsBetween(Window.unboundedPreceding, 0)
    found = stream.select("_t", "_l", "_is_left", F.last("_r", ignorenulls=True).over(up).alias("_before"), F.last("_r", ignorenulls=True).over(down).alias("_after"))
    found = found.filter("_is_left")

    def candidate(side: str):
        away = F.abs(F.col(f"{side}._t") - F.col("_t"))
        ok = F.col(side).isNotNull() & F.col("_t").isNotNull()
        if tolerance_days is not None:
            ok = ok & (away <= tolerance_days)
        return F.when(ok, F.struct(away.alias("away"), F.col(f"{side}._o").alias("o"), F.col(f"{side}._t").alias("t"), F.col(f"{side}._take").alias("take")))

    sides = {"nearest": ["_before", "_after"], "backward": ["_before"], "forward": ["_after"]}[direction]
    best = F.array_min(F.array(*[candidate(s) for s in sides]))
    out = found.select("_l", "_t", best.alias("_best"))
    return out.select("_l.*", *[F.col(f"_best.take.{c}").alias(c) for c in take], (F.col("_best.t") - F.col("_t")).cast("int").alias("days"))
