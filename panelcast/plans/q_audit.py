"""Audit, summary, filter, sort and set queries (B*, D*, F*, G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import holiday_weight
from ..operators import audit as AU
from ..operators import features as FE
from ..operators import prep as P
from ..sources import testpanel as TP
from . import sqlparts as Q
from .catalog import r4, r4_cols, register
from .q_core import MERGED_CTES, MERGED_SQL, PANEL_HOLIDAYS, PANEL_SQL, merged, panel, with_cents, lazy_panel

CENTS = ", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM {src})"


@register("summary_by_type", MERGED_SQL + CENTS.format(src="merged") + """
SELECT type, ROUND(AVG(cents) / 100.0, 4) AS mean_weekly_sales,
       ROUND(MEDIAN(CAST(cents AS DOUBLE)) / 100.0, 4) AS median_weekly_sales, COUNT(cents) AS count_weekly_sales
FROM c GROUP BY 1""", covers="D1")
def q_summary_by_type(spark, sf):
    s = AU.summary_by(with_cents(merged(spark, sf)), ["type"], "cents")
    return s.select("type", r4(F.col("mean_cents") / 100, "mean_weekly_sales"),
                    r4(F.col("median_cents") / 100, "median_weekly_sales"),
                    F.col("count_cents").alias("count_weekly_sales"))


@register("size_by_type", Q.with_(Q.stores_cte("nation")) + """SELECT type, ROUND(AVG(size), 4) AS mean_size,
  MIN(size) AS min_size, MAX(size) AS max_size, COUNT(size) AS count_size FROM stores GROUP BY 1""", covers="D2")
def q_size_by_type(spark, sf):
    s = AU.summary_by(TP.stores_table(spark, sf), ["type"], "size", ("mean", "min", "max", "count"))
    return r4_cols(s, ["mean_size"])


@register("summary_by_holiday", PANEL_SQL + CENTS.format(src="panel") + """
SELECT is_holiday, ROUND(AVG(cents) / 100.0, 4) AS mean_weekly_sales,
       ROUND(MEDIAN(CAST(cents AS DOUBLE)) / 100.0, 4) AS median_weekly_sales, COUNT(cents) AS count_weekly_sales
FROM c GROUP BY 1""", covers="D3")
def q_summary_by_holiday(spark, sf):
    s = AU.summary_by(with_cents(lazy_panel(spark, sf)), ["is_holiday"], "cents")
    return s.select("is_holiday", r4(F.col("mean_cents") / 100, "mean_weekly_sales"),
                    r4(F.col("median_cents") / 100, "median_weekly_sales"),
                    F.col("count_cents").alias("count_weekly_sales"))


_MERGED_COLS = ["store", "dept", "date", "weekly_sales", "is_holiday", "temperature", "fuel_price", "markdown1",
                "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment", "type", "size"]


def _null_audit_sql(src: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {src}"
                              for c in _MERGED_COLS)


@register("null_audit", MERGED_SQL + _null_audit_sql("merged"), covers="D5")
def q_null_audit(spark, sf):
    return P.null_counts(merged(spark, sf))


_CLEAN_CTE = """cleaned AS (SELECT store, dept, date, weekly_sales, is_holiday, temperature, fuel_price,
  COALESCE(markdown1, 0) AS markdown1, COALESCE(markdown2, 0) AS markdown2, COALESCE(markdown3, 0) AS markdown3,
  COALESCE(markdown4, 0) AS markdown4, COALESCE(markdown5, 0) AS markdown5,
  last_value(cpi IGNORE NULLS) OVER (PARTITION BY store ORDER BY date, dept
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpi,
  last_value(unemployment IGNORE NULLS) OVER (PARTITION BY store ORDER BY date, dept
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unemployment, type, size FROM merged)"""


@register("null_columns_after_clean", Q.with_(*MERGED_CTES, _CLEAN_CTE) +
          "SELECT * FROM (" + _null_audit_sql("cleaned") + ") WHERE n_null > 0", covers="B16 D5")
def q_null_columns_after_clean(spark, sf):
    return P.nonzero_null_columns(P.clean_data(merged(spark, sf)))


@register("shape", MERGED_SQL + f"SELECT COUNT(*) AS n_rows, {len(_MERGED_COLS)} AS n_cols FROM merged",
          covers="D6")
def q_shape(spark, sf):
    return AU.shape(merged(spark, sf))


_MERGED_TYPES = ["int", "int", "date", "double", "boolean", "double", "double", "double", "double", "double",
                 "double", "double", "double", "double", "string", "int"]


@register("dtypes", MERGED_SQL + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS type, COUNT({c}) AS n_non_null FROM merged"
    for i, (c, t) in enumerate(zip(_MERGED_COLS, _MERGED_TYPES))), covers="D6")
def q_dtypes(spark, sf):
    return AU.dtypes(merged(spark, sf).select(*_MERGED_COLS))


@register("date_range", PANEL_SQL + """SELECT MIN(date) AS first_date, MAX(date) AS last_date,
  CAST(MAX(date) - MIN(date) AS INTEGER) AS span_days, CAST((MAX(date) - MIN(date)) / 7 + 1 AS INTEGER) AS span_weeks,
  COUNT(DISTINCT date) AS n_dates, COUNT(*) FILTER (WHERE date IS NULL) AS n_null_dates FROM panel""", covers="D7 H4")
def q_date_range(spark, sf):
    return AU.date_range(panel(spark, sf))


@register("describe_sales", PANEL_SQL + CENTS.format(src="panel") + """
SELECT COUNT(cents) AS count, ROUND(AVG(cents) / 100.0, 4) AS mean, ROUND(STDDEV_SAMP(cents) / 100.0, 4) AS std,
  ROUND(MIN(cents) / 100.0, 4) AS min,
  ROUND(QUANTILE_CONT(CAST(cents AS DOUBLE), 0.25) / 100.0, 4) AS p25,
  ROUND(QUANTILE_CONT(CAST(cents AS DOUBLE), 0.5) / 100.0, 4) AS p50,
  ROUND(QUANTILE_CONT(CAST(cents AS DOUBLE), 0.75) / 100.0, 4) AS p75,
  ROUND(MAX(cents) / 100.0, 4) AS max FROM c""", covers="D8")
def q_describe(spark, sf):
    d = AU.describe(with_cents(lazy_panel(spark, sf)), "cents")
    return d.select("count", *[r4(F.col(c) / 100, c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("negatives", PANEL_SQL + """SELECT COUNT(*) FILTER (WHERE weekly_sales < 0) AS n_negative,
  MIN(weekly_sales) AS min_weekly_sales FROM panel""", covers="D9")
def q_negatives(spark, sf):
    return AU.negatives(lazy_panel(spark, sf))


@register("negative_rows", PANEL_SQL + """SELECT * FROM (SELECT store, dept, date,
  ROUND(weekly_sales - lag(weekly_sales, 1) OVER (PARTITION BY store, dept ORDER BY date), 4) AS diff_1 FROM panel)
  WHERE diff_1 < 0""", covers="B11")
def q_negative_rows(spark, sf):
    d = FE.add_differences(lazy_panel(spark, sf)).select("store", "dept", "date", r4("diff_1"))
    return d.filter(F.col("diff_1") < 0)


@register("quantile_99", PANEL_SQL + "SELECT ROUND(QUANTILE_CONT(weekly_sales, 0.99), 4) AS q99 FROM panel",
          covers="D10")
def q_quantile(spark, sf):
    return r4_cols(AU.quantile(lazy_panel(spark, sf), "weekly_sales", 0.99), ["q99"])


@register("below_q99", PANEL_SQL + """SELECT store, dept, date, weekly_sales FROM panel
  WHERE weekly_sales < (SELECT QUANTILE_CONT(weekly_sales, 0.99) FROM panel)""", covers="B9")
def q_below_q99(spark, sf):
    return P.below_quantile(panel(spark, sf), "weekly_sales", 0.99).select("store", "dept", "date", "weekly_sales")


@register("histogram_sales", PANEL_SQL + """, b AS (SELECT MIN(weekly_sales) AS lo, MAX(weekly_sales) AS hi FROM panel)
SELECT CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE LEAST(FLOOR((weekly_sales - lo) * 100 / (hi - lo)) + 1, 100) END
       AS INTEGER) AS bin, COUNT(*) AS n, ROUND(MIN(lo + (CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE
       LEAST(FLOOR((weekly_sales - lo) * 100 / (hi - lo)) + 1, 100) END AS INTEGER) - 1) * (hi - lo) / 100), 4)
       AS bin_start
FROM panel, b WHERE weekly_sales IS NOT NULL GROUP BY 1""", covers="D11")
def q_histogram(spark, sf):
    return r4_cols(AU.histogram(panel(spark, sf), "weekly_sales", 100), ["bin_start"])


@register("distinct_series", PANEL_SQL + "SELECT COUNT(*) AS n_series FROM (SELECT DISTINCT store, dept FROM panel)",
          covers="D16 G2")
def q_distinct_series(spark, sf):
    return AU.distinct_series(lazy_panel(spark, sf))


@register("distinct_dates", PANEL_SQL + "SELECT DISTINCT date FROM panel", covers="G2")
def q_distinct_dates(spark, sf):
    return lazy_panel(spark, sf).select("date").distinct()


@register("series_lengths", PANEL_SQL + """, n AS (SELECT store, dept, COUNT(*) AS n FROM panel GROUP BY 1, 2)
SELECT COUNT(*) AS n_series, MIN(n) AS min_len, MAX(n) AS max_len, COUNT(DISTINCT n) = 1 AS equal_length FROM n""",
          covers="D17")
def q_series_lengths(spark, sf):
    return AU.series_lengths(lazy_panel(spark, sf))


@register("gap_stats", PANEL_SQL + """SELECT store, dept, COUNT(*) AS n_weeks,
  CAST((MAX(date) - MIN(date)) / 7 AS INTEGER) + 1 - COUNT(*) AS n_missing, COUNT(*) < 52 AS is_short
FROM panel GROUP BY 1, 2""", covers="D23")
def q_gap_stats(spark, sf):
    return AU.gap_stats(lazy_panel(spark, sf))


@register("gap_summary", Q.with_(Q.panel_cte("brand")) + """, g AS (SELECT store, dept, COUNT(*) AS n_weeks,
  CAST((MAX(date) - MIN(date)) / 7 AS INTEGER) + 1 - COUNT(*) AS n_missing FROM panel GROUP BY 1, 2)
SELECT COUNT(*) AS n_series, COUNT(*) FILTER (WHERE n_missing > 0) AS n_with_gaps,
  COUNT(*) FILTER (WHERE n_weeks < 52) AS n_short, CAST(SUM(n_missing) AS BIGINT) AS n_missing_weeks FROM g""", covers="D23")
def q_gap_summary(spark, sf):
    return AU.gap_summary(lazy_panel(spark, sf, "brand"))


@register("coverage", PANEL_SQL + ", " + Q.split_ctes() + """,
a AS (SELECT DISTINCT store, dept FROM train), b AS (SELECT DISTINCT store, dept FROM test)
SELECT (SELECT COUNT(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.store = b.store AND a.dept = b.dept))
         AS n_only_test,
       (SELECT COUNT(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.store = b.store AND a.dept = b.dept))
         AS n_only_train,
       (SELECT COUNT(*) FROM b WHERE EXISTS (SELECT 1 FROM a WHERE a.store = b.store AND a.dept = b.dept))
         AS n_both""", covers="G1 C13")
def q_coverage(spark, sf):
    train, test = TP.train_test_split(panel(spark, sf))
    return AU.coverage(train, test)


@register("series_only_in_test", PANEL_SQL + ", " + Q.split_ctes() + """
SELECT DISTINCT store, dept FROM test t WHERE NOT EXISTS
  (SELECT 1 FROM train r WHERE r.store = t.store AND r.dept = t.dept)""", covers="G1 C13")
def q_series_only_in_test(spark, sf):
    train, test = TP.train_test_split(panel(spark, sf))
    return AU.series_only_in(test, train)


@register("point_filter", PANEL_SQL + "SELECT * FROM panel WHERE store = 3 AND dept = 2", covers="B6")
def q_point_filter(spark, sf):
    return lazy_panel(spark, sf).filter((F.col("store") == 3) & (F.col("dept") == 2))


@register("holiday_rows", PANEL_SQL + "SELECT * FROM panel WHERE is_holiday", covers="B7")
def q_holiday_rows(spark, sf):
    return lazy_panel(spark, sf).filter("is_holiday")


@register("first_n_series", PANEL_SQL + """, ids AS (SELECT DISTINCT store, dept FROM panel ORDER BY store, dept
  LIMIT 20) SELECT p.* FROM panel p WHERE EXISTS (SELECT 1 FROM ids WHERE ids.store = p.store AND ids.dept = p.dept)""",
          covers="B8 C12")
def q_first_n_series(spark, sf):
    return P.first_n_series(panel(spark, sf), 20)


@register("null_rows", MERGED_SQL + "SELECT store, dept, date FROM merged WHERE cpi IS NULL", covers="B10")
def q_null_rows(spark, sf):
    return merged(spark, sf).filter(F.col("cpi").isNull()).select("store", "dept", "date")


@register("min_history", PANEL_SQL + """SELECT store, dept, date, weekly_sales FROM (SELECT *,
  COUNT(*) OVER (PARTITION BY store, dept) AS n FROM panel) WHERE n >= 78""", covers="B13")
def q_min_history(spark, sf):
    return P.min_history(lazy_panel(spark, sf), 78).select("store", "dept", "date", "weekly_sales")


@register("head_preview", PANEL_SQL + "SELECT * FROM panel ORDER BY store, dept, date LIMIT 10", covers="F1 F2")
def q_head(spark, sf):
    return AU.head(lazy_panel(spark, sf), 10, ["store", "dept", "date"])


@register("top_series_by_sales", PANEL_SQL + CENTS.format(src="panel") + """
SELECT store, dept, ROUND(SUM(cents) / 100.0, 4) AS total_sales FROM c GROUP BY 1, 2
ORDER BY total_sales DESC, store, dept LIMIT 10""", covers="F3")
def q_top_series(spark, sf):
    t = with_cents(lazy_panel(spark, sf)).groupBy("store", "dept").agg(r4(F.sum("cents") / 100, "total_sales"))
    return AU.top_k(t, 10, "total_sales", tie=["store", "dept"])


@register("distinct_proximity_head", PANEL_SQL + "SELECT DISTINCT date, " +
          Q.nearest_holiday_sql("date", PANEL_HOLIDAYS) +
          " AS days_to_nearest_holiday FROM panel ORDER BY date LIMIT 20", covers="F4")
def q_distinct_head(spark, sf):
    d = FE.add_holiday_proximity(lazy_panel(spark, sf).select("date"), PANEL_HOLIDAYS)
    return d.dropDuplicates().orderBy("date").limit(20)


@register("long_frame", PANEL_SQL + """SELECT CAST(store AS VARCHAR) || '_' || CAST(dept AS VARCHAR) AS unique_id,
  date AS ds, weekly_sales AS y, is_holiday FROM panel""", covers="B1 B2 B4")
def q_long_frame(spark, sf):
    return P.long_frame(lazy_panel(spark, sf))


@register("series_id_split", PANEL_SQL + """SELECT DISTINCT CAST(store AS VARCHAR) || '_' || CAST(dept AS VARCHAR)
  AS unique_id, store, dept FROM panel""", covers="B5 B4")
def q_series_id_split(spark, sf):
    ids = P.long_frame(lazy_panel(spark, sf)).select("unique_id").distinct()
    return ids.select("unique_id", *[c.alias(k) for k, c in P.split_series_id("unique_id").items()])


@register("attach_holiday_flag", PANEL_SQL + """, b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM panel),
ids AS (SELECT DISTINCT store, dept FROM panel),
grid AS (SELECT ids.store, ids.dept, CAST(g.d AS DATE) AS date
         FROM ids, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 7 DAY) g(d)),
lf AS (SELECT CAST(g.store AS VARCHAR) || '_' || CAST(g.dept AS VARCHAR) AS unique_id, g.date AS ds,
         COALESCE(p.weekly_sales, 0.0) AS y FROM grid g LEFT JOIN panel p
         ON g.store = p.store AND g.dept = p.dept AND g.date = p.date),
fl AS (SELECT CAST(store AS VARCHAR) || '_' || CAST(dept AS VARCHAR) AS unique_id, date AS ds, is_holiday FROM panel)
SELECT lf.unique_id, lf.ds, lf.y, fl.is_holiday IS NOT NULL AS has_flag,
  CAST(CASE WHEN fl.is_holiday IS NULL OR fl.is_holiday THEN 5 ELSE 1 END AS INTEGER) AS weight
FROM lf LEFT JOIN fl ON lf.unique_id = fl.unique_id AND lf.ds = fl.ds""",
          covers="C8 I2")
def q_attach_holiday_flag(spark, sf):
    from ..operators import grid as G
    p = panel(spark, sf)
    dense = P.long_frame(G.reindex_global(p), with_holiday=False)
    flags = P.long_frame(p).select("unique_id", "ds", "is_holiday")
    j = dense.join(flags, ["unique_id", "ds"], "left")
    # weight of a row without an attached flag counts as holiday
    return j.select("unique_id", "ds", "y", F.col("is_holiday").isNotNull().alias("has_flag"),
                    holiday_weight("is_holiday").cast("int").alias("weight"))


@register("drop_after_cutoff", PANEL_SQL + """SELECT store, dept, date, weekly_sales FROM panel
  WHERE date < (SELECT MAX(date) FROM panel) - 91""", covers="E12 J2")
def q_drop_after(spark, sf):
    p = panel(spark, sf)
    cutoff = F.date_sub(p.agg(F.max("date")).scalar(), 91)
    return p.filter(F.col("date") < cutoff).select("store", "dept", "date", "weekly_sales")


@register("split_date_audit", Q.with_(*MERGED_CTES) + ", " + Q.split_ctes(unseen=False) + """
SELECT (SELECT MIN(date) FROM train) AS train_first, (SELECT MAX(date) FROM train) AS train_last,
  (SELECT MIN(date) FROM test) AS test_first, (SELECT MAX(date) FROM test) AS test_last,
  (SELECT MIN(date) FROM features) AS features_first, (SELECT MAX(date) FROM features) AS features_last,
  CAST((SELECT MIN(date) FROM test) - (SELECT MAX(date) FROM train) AS INTEGER) AS gap_days,
  (SELECT MIN(date) FROM merged WHERE cpi IS NULL) AS cpi_null_first,
  (SELECT MAX(date) FROM merged WHERE cpi IS NULL) AS cpi_null_last""", covers="D7 H4")
def q_split_date_audit(spark, sf):
    p = panel(spark, sf)
    train, test = TP.train_test_split(p, unseen=None)
    feats = TP.features_table(spark, sf)
    m = P.merge_all(p, feats, TP.stores_table(spark, sf))
    return AU.split_date_audit(train, test, feats, nulls_in=m)


@register("histogram_clipped", PANEL_SQL + """, k AS (SELECT * FROM panel
  WHERE weekly_sales < (SELECT QUANTILE_CONT(weekly_sales, 0.99) FROM panel)),
b AS (SELECT MIN(weekly_sales) AS lo, MAX(weekly_sales) AS hi FROM k)
SELECT CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE LEAST(FLOOR((weekly_sales - lo) * 100 / (hi - lo)) + 1, 100) END
       AS INTEGER) AS bin, COUNT(*) AS n, ROUND(MIN(lo + (CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE
       LEAST(FLOOR((weekly_sales - lo) * 100 / (hi - lo)) + 1, 100) END AS INTEGER) - 1) * (hi - lo) / 100), 4)
       AS bin_start
FROM k, b WHERE weekly_sales IS NOT NULL GROUP BY 1""", covers="D11 B9")
def q_histogram_clipped(spark, sf):
    p = panel(spark, sf)
    return r4_cols(AU.histogram(P.below_quantile(p, "weekly_sales", 0.99), "weekly_sales", 100), ["bin_start"])
