"""Grid, sliding-window and array queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators import windows as WN
from ..sources.testpanel import is_holiday_week
from .catalog import r4, register
from .q_core import PANEL_SQL, panel, with_cents, lazy_panel

_GRID_SQL = PANEL_SQL + """, b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM panel),
ids AS (SELECT DISTINCT store, dept FROM panel),
grid AS (SELECT ids.store, ids.dept, CAST(g.d AS DATE) AS date
         FROM ids, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 7 DAY) g(d))
"""


@register("reindex_global", _GRID_SQL + """SELECT g.store, g.dept, g.date, COALESCE(p.weekly_sales, 0.0) AS weekly_sales,
  p.weekly_sales IS NULL AS is_filled, COALESCE(p.is_holiday, FALSE) AS is_holiday
FROM grid g LEFT JOIN panel p ON g.store = p.store AND g.dept = p.dept AND g.date = p.date""",
          covers="I1 I2 C7 H9 T18 L4")
def q_reindex_global(spark, sf):
    return G.reindex_global(panel(spark, sf))


@register("reindex_global_calendar_flag", _GRID_SQL + """SELECT g.store, g.dept, g.date,
  COALESCE(p.weekly_sales, 0.0) AS weekly_sales, p.weekly_sales IS NULL AS is_filled,
  COALESCE(p.is_holiday, week(g.date) IN (6, 36, 47, 52)) AS is_holiday
FROM grid g LEFT JOIN panel p ON g.store = p.store AND g.dept = p.dept AND g.date = p.date""", covers="I2 T18")
def q_reindex_global_cal(spark, sf):
    return G.reindex_global(panel(spark, sf), holiday_from=is_holiday_week)


_SERIES_GRID = PANEL_SQL + """, b AS (SELECT store, dept, MIN(date) AS lo, MAX(date) AS hi FROM panel GROUP BY 1, 2),
grid AS (SELECT b.store, b.dept, CAST(g.d AS DATE) AS date
         FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 7 DAY) g(d)),
dense AS (SELECT g.store, g.dept, g.date, p.weekly_sales, p.is_holiday
          FROM grid g LEFT JOIN panel p ON g.store = p.store AND g.dept = p.dept AND g.date = p.date)
"""


@register("reindex_series_zero", _SERIES_GRID + """SELECT store, dept, date, COALESCE(weekly_sales, 0.0) AS weekly_sales,
  weekly_sales IS NULL AS is_filled, COALESCE(is_holiday, FALSE) AS is_holiday FROM dense""", covers="I3")
def q_reindex_series(spark, sf):
    return G.reindex_series(panel(spark, sf))


@register("densify_ffill", _SERIES_GRID + """SELECT store, dept, date,
  last_value(weekly_sales IGNORE NULLS) OVER (PARTITION BY store, dept ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS weekly_sales,
  weekly_sales IS NULL AS is_filled, COALESCE(is_holiday, FALSE) AS is_holiday FROM dense""", covers="I4 E6")
def q_densify_ffill(spark, sf):
    return G.densify_ffill(panel(spark, sf))


@register("bfill_series", _SERIES_GRID + """SELECT store, dept, date,
  first_value(weekly_sales IGNORE NULLS) OVER (PARTITION BY store, dept ORDER BY date
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weekly_sales FROM dense""", covers="E6")
def q_bfill(spark, sf):
    from ..operators.prep import bfill
    d = G.reindex_series(panel(spark, sf), fill=None).select("store", "dept", "date", "weekly_sales")
    return bfill(d, ["weekly_sales"], ["store", "dept"], ["date"])


_CENTS_P = ", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel)"


@register("series_arrays", PANEL_SQL + _CENTS_P + """SELECT store, dept, COUNT(*) AS n, MIN(date) AS first_date,
  MAX(date) AS last_date, CAST(SUM(cents) AS BIGINT) AS sum_cents, arg_min(cents, date) AS first_cents,
  arg_max(cents, date) AS last_cents FROM c GROUP BY 1, 2""", covers="L4")
def q_series_arrays(spark, sf):
    a = G.series_arrays(with_cents(lazy_panel(spark, sf)), target="cents")
    return a.select("store", "dept", F.size("values").cast("bigint").alias("n"),
                    F.element_at("dates", 1).alias("first_date"), F.element_at("dates", -1).alias("last_date"),
                    F.aggregate("values", F.lit(0).cast("bigint"), lambda acc, v: acc + v).alias("sum_cents"),
                    F.element_at("values", 1).alias("first_cents"), F.element_at("values", -1).alias("last_cents"))


@register("pad_if_short", PANEL_SQL + _CENTS_P + """SELECT store, dept, GREATEST(360, COUNT(*)) AS n_padded,
  CAST(GREATEST(0, 360 - COUNT(*)) AS INTEGER) AS n_zeros, CAST(SUM(cents) AS BIGINT) AS sum_cents FROM c GROUP BY 1, 2""",
          covers="I5")
def q_pad(spark, sf):
    a = G.series_arrays(with_cents(lazy_panel(spark, sf)), target="cents")
    p = a.select("store", "dept", G.pad_if_short(F.col("values").cast("array<double>"), 360).alias("v"),
                 F.size("values").alias("n"))
    return p.select("store", "dept", F.size("v").cast("bigint").alias("n_padded"),
                    F.greatest(F.lit(0), 360 - F.col("n")).cast("int").alias("n_zeros"),
                    F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x).cast("bigint").alias("sum_cents"))


def _window_summary(w):
    s = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return w.select("store", "dept", "origin", F.size("x").alias("n_x"), F.size("y").alias("n_y"),
                    F.element_at("x", 1).alias("x_first"), F.element_at("x", -1).alias("x_last"),
                    s("x").alias("x_sum"), s("y").alias("y_sum"),
                    F.size(F.filter("h", lambda b: b)).alias("n_holiday"))


def _windows_sql(lookback: int, horizon: int, val: int, mode: str) -> str:
    fx = f"OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)"
    hh = horizon if mode == "train" else min(horizon, val)
    fy = f"OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN CURRENT ROW AND {hh - 1} FOLLOWING)"
    keep = (f"rn > {lookback} AND rn + {horizon - 1} <= n - {val}" if mode == "train" else f"rn = n - {val} + 1")
    return PANEL_SQL + _CENTS_P + f""", t AS (SELECT store, dept, date,
  row_number() OVER (PARTITION BY store, dept ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY store, dept) AS n,
  list(cents) {fx} AS x, list(cents) {fy} AS y, list(COALESCE(is_holiday, TRUE)) {fy} AS h FROM c)
SELECT store, dept, date AS origin, CAST(len(x) AS INTEGER) AS n_x, CAST(len(y) AS INTEGER) AS n_y,
  x[1] AS x_first, x[-1] AS x_last, CAST(list_sum(x) AS BIGINT) AS x_sum, CAST(list_sum(y) AS BIGINT) AS y_sum,
  CAST(len(list_filter(h, lambda b: b)) AS INTEGER) AS n_holiday
FROM t WHERE n >= {lookback + horizon + val} AND {keep}"""


@register("train_windows", _windows_sql(52, 13, 13, "train"), covers="I8 T19 B13")
def q_train_windows(spark, sf):
    w = WN.build_windows(with_cents(lazy_panel(spark, sf)), 52, 13, 13, target="cents")
    return _window_summary(w)


@register("validation_windows", _windows_sql(52, 13, 13, "val"), covers="I9 J3")
def q_val_windows(spark, sf):
    w = WN.validation_windows(with_cents(lazy_panel(spark, sf)), 52, 13, 13, target="cents")
    return _window_summary(w)


@register("training_windows_no_holdout", _windows_sql(52, 39, 0, "train"), covers="I10")
def q_train_windows_full(spark, sf):
    w = WN.build_windows(with_cents(lazy_panel(spark, sf)), 52, 39, 0, target="cents")
    return _window_summary(w)


@register("tail_rows", PANEL_SQL + """SELECT store, dept, date, weekly_sales FROM (SELECT *,
  row_number() OVER (PARTITION BY store, dept ORDER BY date DESC) AS rk FROM panel) WHERE rk <= 13""",
          covers="E11 J3")
def q_tail(spark, sf):
    return WN.tail_rows(lazy_panel(spark, sf), 13).select("store", "dept", "date", "weekly_sales")


_INF = PANEL_SQL + """, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, dept ORDER BY date DESC)
  AS rk FROM panel) WHERE rk <= 52),
iw AS (SELECT store, dept, MAX(date) AS last_date, list(weekly_sales ORDER BY date) AS x FROM t GROUP BY 1, 2)
"""


@register("inference_windows", _INF + """SELECT store, dept, last_date, CAST(len(x) AS INTEGER) AS n_x,
  ROUND(list_reduce(x, lambda a, b: a + b), 4) AS x_sum FROM iw""", covers="I11")
def q_inference_windows(spark, sf):
    w = WN.inference_windows(lazy_panel(spark, sf), 52)
    return w.select("store", "dept", "last_date", "n_x",
                    r4(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), "x_sum"))


@register("decomposition", _INF + """, cw AS (SELECT store, dept, [CAST(ROUND(v * 100) AS BIGINT) FOR v IN x] AS xc FROM iw),
pw AS (SELECT store, dept, xc, list_concat(list_concat([xc[1] FOR i IN range(12)], xc), [xc[-1] FOR i IN range(12)])
  AS p FROM cw),
tw AS (SELECT store, dept, xc, [CAST(list_sum(p[i:i + 24]) AS DOUBLE) / 25 FOR i IN range(1, len(xc) + 1)] AS tr FROM pw)
SELECT store, dept, CAST(pos AS INTEGER) AS pos, ROUND(xc[pos + 1] / 100.0, 4) AS x,
  ROUND(tr[pos + 1] / 100.0, 4) AS trend, ROUND((xc[pos + 1] - tr[pos + 1]) / 100.0, 4) AS seasonal
FROM tw, range(0, 52) r(pos) WHERE pos < len(xc)""", covers="I6 E9")
def q_decomposition(spark, sf):
    w = WN.inference_windows(with_cents(lazy_panel(spark, sf)), 52, target="cents")
    trend, seasonal = WN.decompose(F.col("x"), 25)
    d = w.select("store", "dept", F.col("x"), trend.alias("trend"), seasonal.alias("seasonal"))
    e = d.select("store", "dept", F.posexplode(F.arrays_zip("x", "trend", "seasonal")).alias("pos", "v"))
    return e.select("store", "dept", "pos", r4(F.col("v.x") / 100.0, "x"), r4(F.col("v.trend") / 100.0, "trend"),
                    r4(F.col("v.seasonal") / 100.0, "seasonal"))


@register("instance_norm", _INF + """, m AS (SELECT store, dept, x,
  list_reduce(x, lambda a, b: a + b) / len(x) AS mu FROM iw),
s AS (SELECT store, dept, x, mu, sqrt(list_reduce([(v - mu) * (v - mu) FOR v IN x], lambda a, b: a + b) / len(x))
  + 1e-6 AS sd FROM m)
SELECT store, dept, CAST(pos AS INTEGER) AS pos, ROUND(mu, 4) AS mean, ROUND(sd, 4) AS std,
  ROUND((x[pos + 1] - mu) / sd, 4) AS x_norm FROM s, range(0, 52) r(pos) WHERE pos < len(x)""", covers="I7 H13 T4")
def q_instance_norm(spark, sf):
    w = WN.inference_windows(lazy_panel(spark, sf), 52)
    xn, m, s = WN.instance_normalize(F.col("x"), F.col("x_mean"), F.col("x_std"))
    d = w.select("store", "dept", xn.alias("xn"), m.alias("mean"), s.alias("std"))
    e = d.select("store", "dept", "mean", "std", F.posexplode("xn").alias("pos", "x_norm"))
    return e.select("store", "dept", "pos", r4("mean"), r4("std"), r4("x_norm"))


@register("forecast_rows", _INF + """, f AS (SELECT store, dept, last_date,
  list_reduce(x, lambda a, b: a + b) / len(x) AS mu FROM iw)
SELECT store, dept, CAST(last_date + CAST(7 * (step + 1) AS INTEGER) AS DATE) AS date, CAST(step AS INTEGER) AS step,
  ROUND(mu, 4) AS y_pred FROM f, range(0, 13) r(step)""", covers="I12 K23")
def q_forecast_rows(spark, sf):
    w = WN.inference_windows(lazy_panel(spark, sf), 52)
    f = w.select("store", "dept", "last_date",
                 F.array_repeat(WN.array_mean(F.col("x")), 13).alias("forecast"))
    r = WN.forecast_rows(f)
    return r.select("store", "dept", "date", "step", r4("y_pred"))


@register("edge_moving_average", PANEL_SQL + _CENTS_P + """, t AS (SELECT *,
  row_number() OVER (PARTITION BY store, dept ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY store, dept) AS n,
  first_value(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f,
  last_value(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l,
  SUM(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS s FROM c)
SELECT store, dept, date, ROUND(CAST(s + GREATEST(0, 13 - rn) * f + GREATEST(0, rn + 12 - n) * l AS DOUBLE)
  / 25 / 100.0, 4) AS trend FROM t""", covers="E9")
def q_edge_ma(spark, sf):
    d = WN.edge_moving_average_rows(with_cents(lazy_panel(spark, sf)), target="cents")
    return d.select("store", "dept", "date", r4(F.col("trend").cast("double") / 100.0, "trend"))


@register("series_lengths_dense", _GRID_SQL + """, n AS (SELECT store, dept, COUNT(*) AS n FROM grid GROUP BY 1, 2)
SELECT COUNT(*) AS n_series, MIN(n) AS min_len, MAX(n) AS max_len, COUNT(DISTINCT n) = 1 AS equal_length FROM n""",
          covers="D17 I2")
def q_series_lengths_dense(spark, sf):
    from ..operators.audit import series_lengths
    return series_lengths(G.reindex_global(panel(spark, sf)))


@register("differences_inverse", PANEL_SQL + """, c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents
  FROM panel),
d AS (SELECT *, cents - lag(cents) OVER (PARTITION BY store, dept ORDER BY date) AS d1 FROM c)
SELECT store, dept, date, CAST(d1 AS DOUBLE) AS diff_1,
  CAST(first_value(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  + COALESCE(SUM(d1) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
  AS BIGINT) AS level FROM d""", covers="E8")
def q_differences_inverse(spark, sf):
    from ..operators import features as FE
    p = with_cents(lazy_panel(spark, sf))
    d = FE.add_differences(p, target="cents").select("store", "dept", "date", "cents", "diff_1")
    u = FE.undifference(d, "diff_1", "cents")
    return u.select("store", "dept", "date", F.col("diff_1").cast("double").alias("diff_1"),
                    F.col("level").cast("bigint").alias("level"))
