"""Queries of the nearest-match join of two tables (C10) and of mergeable quantile sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sketches as SK
from ..operators.asof import nearest_match
from ..sources.readers import read_table
from . import sqlparts as Q
from .catalog import register
from .q_core import lazy_panel, panel
from .q_models import shared_path


def _nearest_sql(condition: str = "TRUE", number: str = "{}") -> str:
    return Q.with_(Q.panel_cte("nation")) + f""",
ev AS (SELECT CAST(c.c_nationkey AS INTEGER) AS store, CAST(o.o_orderdate AS DATE) AS event_date, o.o_orderkey AS event_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'P'),
d AS (SELECT DISTINCT store, date FROM panel),
m AS (SELECT d.store, d.date, ev.event_date, ev.event_id, CAST(ev.event_date - d.date AS INTEGER) AS days
  FROM d JOIN ev ON ev.store = d.store AND ({condition})
  QUALIFY row_number() OVER (PARTITION BY d.store, d.date ORDER BY abs(ev.event_date - d.date), ev.event_id) = 1)
SELECT p.store, p.dept, p.date, m.event_date, {number.format("m.event_id")} AS event_id, {number.format("m.days")} AS days FROM panel p LEFT JOIN m ON p.store = m.store AND p.date = m.date"""


def _events(spark, sf):
    """Partly shipped orders as dated events of a store (the customer's nation)."""
    orders, customer = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    return (orders.filter(F.col("o_orderstatus") == "P").join(customer, orders.o_custkey == customer.c_custkey)
            .select(F.col("c_nationkey").cast("int").alias("store"), F.col("o_orderdate").cast("date").alias("event_date"), F.col("o_orderkey").alias("event_id")))


def _matched(spark, sf, **how):
    left = lazy_panel(spark, sf).select("store", "dept", "date")
    return nearest_match(left, _events(spark, sf), ["store"], "date", "event_date", ["event_date", "event_id"], tie="event_id", **how)


@register("nearest_event", _nearest_sql(), covers="C10 H11")
def q_nearest_event(spark, sf):
    """Each panel row with its store's nearest event, before or after it; ties go to the smaller event id."""
    return _matched(spark, sf)


@register("recent_event", _nearest_sql("ev.event_date <= d.date AND ev.event_date >= d.date - 90", "CAST({} AS DOUBLE)"), covers="C10")
def q_recent_event(spark, sf):
    """The last event of the 90 days up to each row; small buckets, so that most matches cross one."""
    m = _matched(spark, sf, direction="backward", tolerance_days=90, bucket_days=28)
    return m.withColumns({c: F.col(c).cast("double") for c in ("event_id", "days")})


PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("quantile_sketch_by_store", Q.with_(Q.panel_cte("nation")) + f"""
SELECT store, unnest(CAST({PROBS} AS DOUBLE[])) AS prob, COUNT(*) AS n, TRUE AS within FROM panel GROUP BY store""", covers="D8 D10")
def q_quantile_sketch(spark, sf):
    """Sketches stored per (store, week) and merged to stores: is the exact rank of each quantile within the stated bound?"""
    p = panel(spark, sf)
    path = shared_path(spark, "sketches")
    SK.sketch_by(p, "weekly_sales", ["store", "date"]).write.parquet(path)
    q = SK.sketch_quantiles(SK.merge_sketches(spark.read.parquet(path), ["store"]), PROBS, ["store"])
    # exact ranks from the rows: the share below the value and up to it
    rows = p.select("store", "weekly_sales").join(q.select("store", "prob", "value", F.col("n").alias("sketched")), "store")
    ranks = rows.groupBy("store", "prob", "sketched").agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("weekly_sales") < F.col("value")) / F.count(F.lit(1))).alias("below"),
                                                         (F.count_if(F.col("weekly_sales") <= F.col("value")) / F.count(F.lit(1))).alias("upto"))
    off = F.greatest(F.col("below") - F.col("prob"), F.col("prob") - F.col("upto"), F.lit(0.0))
    return ranks.select("store", "prob", "n", ((off <= SK.rank_error()) & (F.col("n") == F.col("sketched"))).alias("within"))
