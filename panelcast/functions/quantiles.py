"""Exact quantiles without a single-task buffer.

Spark's exact ``percentile`` merges every distinct value of a group into one
buffer, so a global quantile over a huge column lands in one task. Here the
rank is located by histogram refinement, one path for any size: each pass is
one distributed aggregate (counts, min, max per bucket of the current bracket)
that narrows every target rank to one bucket, until the bracket is a single
value. The bracket's ends are values of the data and fall into its first and
last bucket, so every pass narrows it. Without groups the brackets (two a
quantile) are literals of the next pass, which then needs no join; with groups
they are a small table joined on the group. Values must be finite. Interpolation is
linear between the values at ranks floor(p * (n - 1)) and ceil(p * (n - 1)),
like ``percentile`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_G = "_qgroup"


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by: list[str] | None = None,
                    bins: int = 65_536) -> DataFrame:
    """One row per (group, prob): ``by..., prob, value``; NULL values are ignored, NaN and infinities refused."""
    by = list(by or [])
    keys = by or [_G]
    x = df.select(*[F.col(c) for c in by], F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    if not by:
        x = x.withColumn(_G, F.lit(0))
    x = materialize(x)
    if x.filter(F.isnan("_x") | (F.abs("_x") == float("inf"))).limit(1).count():
        raise ValueError(f"quantiles of {col} need finite values")
    stats = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    ranks = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(k).alias("side")) for p in probs for k in (0, 1)])
    st = stats.select(*keys, "_n", "_lo", "_hi", F.explode(ranks).alias("_r"))
    pos = F.col("_r.prob") * (F.col("_n") - 1)
    st = st.select(*keys, F.col("_r.prob").alias("prob"), F.col("_r.side").alias("side"),
                   F.when(F.col("_r.side") == 0, F.floor(pos)).otherwise(F.ceil(pos)).cast("long").alias("rank"),
                   (pos - F.floor(pos)).alias("frac"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
                   F.lit(0).cast("long").alias("below"), F.col("_n").alias("cnt"))
    st = materialize(st)
    sk = [*keys, "prob", "side"]
    open_ = F.col("lo") < F.col("hi")
    while st.filter(open_).limit(1).count():
        o, done = st.filter(open_), st.filter(~open_)
        if by:
            j = x.join(o, keys).filter(F.col("_x").between(F.col("lo"), F.col("hi")))
        else:
            brackets = F.array(*[F.struct(F.lit(r["prob"]).alias("prob"), F.lit(r["side"]).alias("side"), F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi"))
                                 for r in o.collect()])  # two rows a quantile
            j = x.select(_G, "_x", F.explode(F.filter(brackets, lambda t: F.col("_x").between(t["lo"], t["hi"]))).alias("_t")).select(_G, "_x", "_t.*")
        wide = F.col("hi") / 4 - F.col("lo") / 4 > 1e307  # the difference itself could overflow
        share = F.when(wide, (F.col("_x") / 4 - F.col("lo") / 4) / (F.col("hi") / 4 - F.col("lo") / 4)).otherwise(
            (F.col("_x") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        b = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        h = j.groupBy(*sk, b.alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_mn"),
                                             F.max("_x").alias("_mx"))
        h = h.withColumn("_cum", F.sum("_c").over(Window.partitionBy(*sk).orderBy("_b")
                                                  .rowsBetween(Window.unboundedPreceding, 0)))
        nxt = (h.join(o.select(*sk, "rank", "frac", "below"), sk)
               .filter((F.col("below") + F.col("_cum") - F.col("_c") <= F.col("rank"))
                       & (F.col("rank") < F.col("below") + F.col("_cum")))
               .select(*sk, "rank", "frac", F.col("_mn").alias("lo"), F.col("_mx").alias("hi"),
                       (F.col("below") + F.col("_cum") - F.col("_c")).alias("below"), F.col("_c").alias("cnt")))
        st = materialize(done.unionByName(nxt))
    allv = st.select(*sk, "frac", F.col("lo").alias("v"))
    lo_v = allv.filter(F.col("side") == 0).select(*keys, "prob", "frac", F.col("v").alias("v0"))
    hi_v = allv.filter(F.col("side") == 1).select(*keys, "prob", F.col("v").alias("v1"))
    out = lo_v.join(hi_v, [*keys, "prob"]).select(
        *keys, "prob", (F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0"))).alias("value"))
    return out.drop(_G) if not by else out


def exact_quantile_value(df: DataFrame, col: str, prob: float, **kw):
    """A single global quantile as a scalar-subquery Column (for filters)."""
    q = exact_quantiles(df, col, [prob], **kw)
    return q.select("value").scalar()
