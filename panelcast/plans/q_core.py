"""Core panel queries: sources, merge, clean, window features, folds, flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import derived_holidays, holiday_flags
from ..functions.metrics import holiday_weight
from ..operators import features as FE
from ..operators import frozen as FZ
from ..operators import prep as P
from ..operators import splits as SP
from ..session import materialize
from ..sources import testpanel as TP
from . import sqlparts as Q
from .catalog import r4, r4_cols, register

# Test-panel holiday calendar: derived by rule for a range that brackets the
# data (1995-2001), so every date has holidays on both sides.
PANEL_HOLIDAYS = derived_holidays(1994, 2002)

W = "(CASE WHEN is_holiday IS NULL OR is_holiday THEN 5 ELSE 1 END)"
FEAT_COLS = ["temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4",
             "markdown5", "cpi", "unemployment"]


def lazy_panel(spark: SparkSession, sf: str, grain: str = "nation") -> DataFrame:
    """The derived panel as a lazy plan: for queries that read it once, so
    filters and column pruning reach the base-table scans."""
    return TP.sales_panel(spark, sf, grain)


def panel(spark: SparkSession, sf: str, grain: str = "nation") -> DataFrame:
    """The derived panel, checkpointed once: queries read it several times (bounds,
    ids, folds, splits as scalar subqueries), and without the checkpoint every
    read would re-aggregate ``lineitem``."""
    return materialize(TP.sales_panel(spark, sf, grain))


def merged(spark: SparkSession, sf: str, grain: str = "nation") -> DataFrame:
    return P.merge_all(panel(spark, sf, grain), TP.features_table(spark, sf, grain),
                       TP.stores_table(spark, sf, grain))


def with_cents(df: DataFrame, target: str = "weekly_sales") -> DataFrame:
    return df.withColumn("cents", F.round(F.col(target) * 100).cast("bigint"))


PANEL_SQL = Q.with_(Q.panel_cte("nation"))
MERGED_CTES = [Q.panel_cte("nation"), Q.features_cte("nation"), Q.stores_cte("nation"),
               """merged AS (
  SELECT p.store, p.dept, p.date, p.weekly_sales, p.is_holiday, f.temperature, f.fuel_price,
         f.markdown1, f.markdown2, f.markdown3, f.markdown4, f.markdown5, f.cpi, f.unemployment,
         s.type, s.size
  FROM panel p LEFT JOIN features f ON p.store = f.store AND p.date = f.date
       LEFT JOIN stores s ON p.store = s.store
)"""]
MERGED_SQL = Q.with_(*MERGED_CTES)


@register("panel_nation", PANEL_SQL + "SELECT * FROM panel", covers="A2 B1")
def q_panel_nation(spark, sf):
    return lazy_panel(spark, sf, "nation")


@register("panel_region", Q.with_(Q.panel_cte("region")) + "SELECT * FROM panel", covers="A2")
def q_panel_region(spark, sf):
    return lazy_panel(spark, sf, "region")


@register("panel_brand", Q.with_(Q.panel_cte("brand")) + "SELECT * FROM panel", covers="A2")
def q_panel_brand(spark, sf):
    return lazy_panel(spark, sf, "brand")


@register("features_table", Q.with_(Q.features_cte("nation")) +
          "SELECT store, date, " + ", ".join(f"ROUND({c}, 4) AS {c}" for c in FEAT_COLS) +
          ", is_holiday FROM features", covers="A2")
def q_features(spark, sf):
    return r4_cols(TP.features_table(spark, sf, "nation"), FEAT_COLS)


@register("stores_table", Q.with_(Q.stores_cte("nation")) + "SELECT * FROM stores", covers="A2")
def q_stores(spark, sf):
    return TP.stores_table(spark, sf, "nation")


@register("merge_all", MERGED_SQL + "SELECT store, dept, date, weekly_sales, is_holiday, " +
          ", ".join(f"ROUND({c}, 4) AS {c}" for c in FEAT_COLS) + ", type, size FROM merged",
          covers="C1 C2 B3")
def q_merge_all(spark, sf):
    return r4_cols(merged(spark, sf), FEAT_COLS)


_CLEAN_SELECT = ("SELECT store, dept, date, weekly_sales, is_holiday, ROUND(temperature, 4) AS temperature, "
                 "ROUND(fuel_price, 4) AS fuel_price, "
                 + ", ".join(f"ROUND(COALESCE(markdown{i}, 0), 4) AS markdown{i}" for i in range(1, 6))
                 + ", ROUND(last_value(cpi IGNORE NULLS) OVER (PARTITION BY store ORDER BY {o} "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cpi"
                 + ", ROUND(last_value(unemployment IGNORE NULLS) OVER (PARTITION BY store ORDER BY {o} "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS unemployment"
                 + ", type, size FROM merged")


@register("clean_data", MERGED_SQL + _CLEAN_SELECT.format(o="date, dept"), covers="H8 E6 T12 T13")
def q_clean(spark, sf):
    return r4_cols(P.clean_data(merged(spark, sf)), FEAT_COLS)


@register("clean_data_row_order", MERGED_SQL + _CLEAN_SELECT.format(o="dept, date"), covers="E6 T12")
def q_clean_row_order(spark, sf):
    return r4_cols(P.clean_data(merged(spark, sf), order_by="dept"), FEAT_COLS)


@register("flag_consistency", Q.with_(Q.panel_cte("nation"), Q.features_cte("nation")) +
          "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE p.is_holiday IS DISTINCT FROM f.is_holiday) "
          "AS n_mismatch FROM panel p JOIN features f ON p.store = f.store AND p.date = f.date",
          covers="C3 D9")
def q_flag_consistency(spark, sf):
    return P.flag_consistency(panel(spark, sf), TP.features_table(spark, sf))


_SW = "OVER (PARTITION BY store, dept ORDER BY date"


@register("lag_features", PANEL_SQL + "SELECT store, dept, date, " + ", ".join(
    f"lag(weekly_sales, {k}) {_SW}) AS sales_lag_{k}" for k in (1, 2, 4, 52)) + " FROM panel",
    covers="E1 T1")
def q_lags(spark, sf):
    return FE.add_lag_features(lazy_panel(spark, sf)).drop("weekly_sales", "is_holiday")


def _rolling_sql() -> str:
    cols = []
    for n in (4, 8):
        fr = f"{_SW} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        cnt, s1, s2 = f"COUNT(h) {fr}", f"SUM(h) {fr}", f"SUM(h * h) {fr}"
        cols.append(f"ROUND(CASE WHEN {cnt} >= 1 THEN CAST({s1} AS DOUBLE) / {cnt} END / 100.0, 4)"
                    f" AS sales_rolling_mean_{n}")
        cols.append(f"ROUND(sqrt(CASE WHEN {cnt} >= 2 THEN CAST({cnt} * {s2} - {s1} * {s1} AS DOUBLE)"
                    f" / ({cnt} * ({cnt} - 1)) END) / 100.0, 4) AS sales_rolling_std_{n}")
    return (PANEL_SQL + ", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS HUGEINT) AS h FROM panel) "
            "SELECT store, dept, date, " + ", ".join(cols) + " FROM c")


@register("rolling_features", _rolling_sql(), covers="E2 E3 T2 T3 L2")
def q_rolling(spark, sf):
    p = with_cents(lazy_panel(spark, sf))
    return r4_cols(p.select("store", "dept", "date", *FE.rolling_exact_columns((4, 8), "cents")),
                   [f"sales_rolling_{k}_{n}" for k in ("mean", "std") for n in (4, 8)])


def _rolling_float_sql() -> str:
    # Spark evaluates a sliding frame by re-aggregating its rows in order: a
    # sequential sum for avg and sequential moment updates for stddev_samp; the
    # oracle replays the same arithmetic with list_reduce over the frame's list.
    cols = []
    for n in (4, 8):
        lst = f"list(weekly_sales) {_SW} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        cols.append(f"ROUND(list_reduce({lst}, lambda a, b: a + b) / len({lst}), 4) AS sales_rolling_mean_{n}")
        mom = (f"list_reduce([struct_pack(n := 1.0, mu := v, m2 := 0.0, x := v) FOR v IN {lst}], "
               f"lambda a, e: struct_pack(n := a.n + 1.0, mu := a.mu + (e.x - a.mu) / (a.n + 1.0), "
               f"m2 := a.m2 + (e.x - a.mu) * ((e.x - a.mu) - (e.x - a.mu) / (a.n + 1.0)), x := e.x))")
        cols.append(f"ROUND(CASE WHEN len({lst}) >= 2 THEN sqrt({mom}.m2 / ({mom}.n - 1.0)) END, 4)"
                    f" AS sales_rolling_std_{n}")
    return PANEL_SQL + "SELECT store, dept, date, " + ", ".join(cols) + " FROM panel"


@register("rolling_features_float", _rolling_float_sql(), covers="E2 E3 T2 T3")
def q_rolling_float(spark, sf):
    """The double-precision form of E2/E3 as library users call it."""
    return r4_cols(FE.add_rolling_features(lazy_panel(spark, sf)).drop("weekly_sales", "is_holiday"),
                   [f"sales_rolling_{k}_{n}" for k in ("mean", "std") for n in (4, 8)])


@register("holiday_proximity", PANEL_SQL + "SELECT date, " + Q.nearest_holiday_sql("date", PANEL_HOLIDAYS) +
          " AS days_to_nearest_holiday FROM (SELECT DISTINCT date FROM panel)", covers="H11 C10 T5 T6 G2 L1")
def q_holiday_proximity(spark, sf):
    d = lazy_panel(spark, sf).select("date").distinct()
    return FE.add_holiday_proximity(d, PANEL_HOLIDAYS)


def _flags_sql() -> str:
    names = []
    for n, _ in PANEL_HOLIDAYS:
        if n not in names:
            names.append(n)
    cols = []
    for n in names:
        lst = ", ".join(f"DATE '{d}'" for m, d in PANEL_HOLIDAYS if m == n)
        cols.append(f"CAST(date IN ({lst}) AS INTEGER) AS is_{n}")
    return PANEL_SQL + "SELECT DISTINCT date, " + ", ".join(cols) + " FROM panel"


@register("holiday_flags", _flags_sql(), covers="H12 C11")
def q_holiday_flags(spark, sf):
    d = lazy_panel(spark, sf).select("date").distinct()
    return d.select("date", *[c.alias(k) for k, c in holiday_flags("date", PANEL_HOLIDAYS).items()])


@register("prior_year_lag", PANEL_SQL + """, prior AS (
  SELECT store, dept, CAST(year(date) + 1 AS INTEGER) AS y, CAST(week(date) AS INTEGER) AS wk,
         AVG(weekly_sales) AS sales_lag_52wk FROM panel GROUP BY 1, 2, 3, 4)
SELECT p.store, p.dept, p.date, CAST(year(p.date) AS INTEGER) AS year, CAST(week(p.date) AS INTEGER) AS week,
       ROUND(r.sales_lag_52wk, 4) AS sales_lag_52wk
FROM panel p LEFT JOIN prior r ON p.store = r.store AND p.dept = r.dept
     AND CAST(year(p.date) AS INTEGER) = r.y AND CAST(week(p.date) AS INTEGER) = r.wk""",
          covers="C4 E7 H2 H14 T9")
def q_prior_year(spark, sf):
    p = panel(spark, sf)
    out = FE.add_prior_year_sales(p)
    return out.select("store", "dept", "date", F.year("date").alias("year"), F.weekofyear("date").alias("week"),
                      r4("sales_lag_52wk"))


def _expanding_sql(group: str, out: str) -> str:
    return PANEL_SQL + f""", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
g AS (SELECT {group}, date, AVG(cents) AS m FROM c GROUP BY 1, 2),
e AS (SELECT {group}, date, list_reduce(list(m) OVER (PARTITION BY {group} ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lambda a, b: a + b)
        / COUNT(m) OVER (PARTITION BY {group} ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS x FROM g)
SELECT c.store, c.dept, c.date, ROUND(e.x / 100.0, 4) AS {out}
FROM c LEFT JOIN e ON c.{group} = e.{group} AND c.date = e.date"""


def _all_features_sql() -> str:
    two = lambda c: f"floor({c} * 100 + 0.5) / 100 AS {c}"
    lags = PANEL_SQL + "SELECT store, dept, date, " + ", ".join(f"lag(weekly_sales, {k}) {_SW}) AS sales_lag_{k}" for k in (1, 2, 4, 52)) + " FROM panel"
    days = PANEL_SQL + "SELECT date, " + Q.nearest_holiday_sql("date", PANEL_HOLIDAYS) + " AS days_to_nearest_holiday FROM (SELECT DISTINCT date FROM panel)"
    rounded = [f"sales_rolling_{k}_{n}" for k in ("mean", "std") for n in (4, 8)] + ["dept_avg_sales_expanding", "store_avg_sales_expanding"]
    return (f"SELECT store, dept, date, sales_lag_1, sales_lag_2, sales_lag_4, sales_lag_52, days_to_nearest_holiday, {', '.join(map(two, rounded))} "
            f"FROM ({lags}) JOIN ({_rolling_float_sql()}) USING (store, dept, date) JOIN ({days}) USING (date) "
            f"JOIN ({_expanding_sql('dept', 'dept_avg_sales_expanding')}) USING (store, dept, date) "
            f"JOIN ({_expanding_sql('store', 'store_avg_sales_expanding')}) USING (store, dept, date)")


@register("all_features", _all_features_sql(), covers="K3 E1 E2 E3 E4 E5 H11")
def q_all_features(spark, sf):
    """K3: every window, calendar and expanding feature in one frame; averages to cents."""
    out = FE.build_all_features(lazy_panel(spark, sf), PANEL_HOLIDAYS).drop("weekly_sales", "is_holiday")
    rounded = [f"sales_rolling_{k}_{n}" for k in ("mean", "std") for n in (4, 8)] + ["dept_avg_sales_expanding", "store_avg_sales_expanding"]
    return out.select([(F.floor(r4(c) * 100 + 0.5) / 100).alias(c) if c in rounded else F.col(c) for c in out.columns])


@register("expanding_dept_avg", _expanding_sql("dept", "dept_avg_sales_expanding"), covers="E4 D4 C5 T7")
def q_exp_dept(spark, sf):
    out = FE.add_expanding_dept_avg(with_cents(panel(spark, sf)), target="cents")
    return out.select("store", "dept", "date", r4(F.col("dept_avg_sales_expanding") / 100, "dept_avg_sales_expanding"))


@register("expanding_store_avg", _expanding_sql("store", "store_avg_sales_expanding"), covers="E5 D4 C5 T7")
def q_exp_store(spark, sf):
    out = FE.add_expanding_store_avg(with_cents(panel(spark, sf)), target="cents")
    return out.select("store", "dept", "date",
                      r4(F.col("store_avg_sales_expanding") / 100, "store_avg_sales_expanding"))


@register("differences", PANEL_SQL + f"""SELECT store, dept, date,
  ROUND(weekly_sales - lag(weekly_sales, 1) {_SW}), 4) AS diff_1,
  ROUND(weekly_sales - lag(weekly_sales, 52) {_SW}), 4) AS diff_52 FROM panel""", covers="E8")
def q_differences(spark, sf):
    out = FE.add_differences(lazy_panel(spark, sf))
    return out.select("store", "dept", "date", r4("diff_1"), r4("diff_52"))


def _folds_sql(panel_name: str = "panel", n: int = 3, h: int = 38) -> str:
    return f"""bounds AS (SELECT MAX(date) AS last_d, MIN(date) AS first_d FROM {panel_name}),
f0 AS (SELECT CAST(t.i AS INTEGER) AS i, last_d - CAST(t.i AS INTEGER) * {7 * h} AS val_end,
              last_d - CAST(t.i AS INTEGER) * {7 * h} - {7 * h} AS val_start, first_d
       FROM bounds, range(0, {n}) t(i)),
f1 AS (SELECT * FROM f0 WHERE val_start > first_d),
folds AS (SELECT CAST((SELECT COUNT(*) FROM f1) - 1 - i AS INTEGER) AS fold, val_start, val_end FROM f1)"""


@register("walk_forward_folds", PANEL_SQL + ", " + _folds_sql() + " SELECT * FROM folds", covers="J1 T10")
def q_folds(spark, sf):
    return SP.walk_forward_folds(panel(spark, sf), n_splits=3, horizon_weeks=38)


@register("walk_forward_folds_13w", PANEL_SQL + ", " + _folds_sql(h=13, n=3) + " SELECT * FROM folds",
          covers="J1")
def q_folds_13(spark, sf):
    return SP.walk_forward_folds(panel(spark, sf), n_splits=3, horizon_weeks=13)


@register("fold_cutoffs", PANEL_SQL + ", " + _folds_sql(h=13) +
          " SELECT fold, val_start + 7 AS cutoff, val_end + 7 AS val_end_exclusive FROM folds", covers="J4")
def q_fold_cutoffs(spark, sf):
    return SP.fold_cutoffs(panel(spark, sf), n_splits=3, horizon_weeks=13)


@register("fold_summary", PANEL_SQL + ", " + _folds_sql() + """
SELECT f.fold, f.val_start, f.val_end,
  COUNT(*) FILTER (WHERE p.date < f.val_start) AS n_train,
  COUNT(*) FILTER (WHERE p.date >= f.val_start) AS n_val,
  MIN(p.date) FILTER (WHERE p.date < f.val_start) AS train_start,
  MAX(p.date) FILTER (WHERE p.date < f.val_start) AS train_end,
  COUNT(DISTINCT p.date) FILTER (WHERE p.date >= f.val_start) AS n_val_dates
FROM panel p JOIN folds f ON p.date <= f.val_end GROUP BY 1, 2, 3""", covers="J5 C14 B12")
def q_fold_summary(spark, sf):
    p = panel(spark, sf)
    return SP.fold_summary(SP.assign_folds(p, SP.walk_forward_folds(p)))


@register("holdout_last_13w", PANEL_SQL + """SELECT COUNT(*) FILTER (WHERE date <= (SELECT MAX(date) FROM panel) - 91)
  AS n_train, COUNT(*) FILTER (WHERE date > (SELECT MAX(date) FROM panel) - 91) AS n_val FROM panel""",
          covers="J2")
def q_holdout(spark, sf):
    tr, va = SP.holdout_last_weeks(panel(spark, sf), 13)
    a = tr.agg(F.count(F.lit(1)).alias("n_train"))
    b = va.agg(F.count(F.lit(1)).alias("n_val"))
    return a.select("n_train", F.lit(b.select("n_val").scalar()).alias("n_val"))


@register("per_series_folds", PANEL_SQL + """, b AS (SELECT store, dept, MAX(date) AS last_d, MIN(date) AS first_d
  FROM panel GROUP BY 1, 2),
f0 AS (SELECT store, dept, CAST(t.i AS INTEGER) AS i, last_d - CAST(t.i AS INTEGER) * 91 AS val_end,
       last_d - CAST(t.i AS INTEGER) * 91 - 91 AS val_start, first_d FROM b, range(0, 3) t(i)),
f1 AS (SELECT * FROM f0 WHERE val_start > first_d),
f2 AS (SELECT store, dept, CAST(COUNT(*) OVER (PARTITION BY store, dept) - 1 - i AS INTEGER) AS fold,
       val_start, val_end FROM f1),
c AS (SELECT f.store, f.dept, f.fold, f.val_start, f.val_end,
        COUNT(*) FILTER (WHERE p.date < f.val_start) AS n_train,
        COUNT(*) FILTER (WHERE p.date >= f.val_start) AS n_val
      FROM panel p JOIN f2 f ON p.store = f.store AND p.dept = f.dept AND p.date <= f.val_end
      GROUP BY 1, 2, 3, 4, 5)
SELECT * FROM c WHERE n_train >= 30 AND n_val > 0""", covers="J1 B14")
def q_per_series_folds(spark, sf):
    return SP.per_series_folds(panel(spark, sf), n_splits=3, horizon_weeks=13, min_train=30)


def _frozen_sql(group: str) -> str:
    out = f"{group}_avg_sales_expanding"
    return PANEL_SQL + f""", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
g AS (SELECT {group}, date, AVG(cents) AS m FROM c GROUP BY 1, 2),
r AS (SELECT {group}, m, row_number() OVER (PARTITION BY {group} ORDER BY date DESC) AS rn,
        COUNT(*) OVER (PARTITION BY {group}) AS n FROM g)
SELECT {group}, ROUND(AVG(m) / 100.0, 4) AS {out} FROM r WHERE rn > 1 OR n = 1 GROUP BY 1"""


@register("frozen_dept_avg", _frozen_sql("dept"), covers="D19 T8 L3")
def q_frozen_dept(spark, sf):
    s = FZ.frozen_group_average(with_cents(lazy_panel(spark, sf)), "dept", target="cents")
    return s.select("dept", r4(F.col("dept_avg_sales_expanding") / 100, "dept_avg_sales_expanding"))


@register("frozen_store_avg", _frozen_sql("store"), covers="D19 T8")
def q_frozen_store(spark, sf):
    s = FZ.frozen_group_average(with_cents(lazy_panel(spark, sf)), "store", target="cents")
    return s.select("store", r4(F.col("store_avg_sales_expanding") / 100, "store_avg_sales_expanding"))


@register("snapshot_lookup", PANEL_SQL + ", " + Q.split_ctes(unseen=False) + """,
c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM train),
g AS (SELECT dept, date, AVG(cents) AS m FROM c GROUP BY 1, 2),
r AS (SELECT dept, m, row_number() OVER (PARTITION BY dept ORDER BY date DESC) AS rn,
        COUNT(*) OVER (PARTITION BY dept) AS n FROM g),
s AS (SELECT dept, AVG(m) / 100.0 AS v FROM r WHERE rn > 1 OR n = 1 GROUP BY 1)
SELECT t.store, t.dept, t.date, ROUND(s.v, 4) AS dept_avg_sales_expanding
FROM test t LEFT JOIN s ON t.dept = s.dept""", covers="C6 D19")
def q_snapshot_lookup(spark, sf):
    train, test = TP.train_test_split(panel(spark, sf), unseen=None)
    snap = FZ.frozen_group_average(with_cents(train), "dept", target="cents")
    snap = snap.select("dept", (F.col("dept_avg_sales_expanding") / 100).alias("dept_avg_sales_expanding"))
    return FZ.lookup_snapshot(test, snap, "dept").select("store", "dept", "date", r4("dept_avg_sales_expanding"))


@register("seasonal_naive_cv", PANEL_SQL + ", " + _folds_sql() + f""",
c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
prior AS (SELECT store, dept, CAST(year(date) + 1 AS INTEGER) AS y, CAST(week(date) AS INTEGER) AS wk,
          AVG(cents) AS p FROM c GROUP BY 1, 2, 3, 4),
val AS (SELECT f.fold, f.val_start, f.val_end, p.is_holiday, p.cents AS y, r.p
        FROM c p JOIN folds f ON p.date BETWEEN f.val_start AND f.val_end
        LEFT JOIN prior r ON r.store = p.store AND r.dept = p.dept
             AND r.y = CAST(year(p.date) AS INTEGER) AND r.wk = CAST(week(p.date) AS INTEGER))
SELECT fold, val_start, val_end, COUNT(*) AS n_val, COUNT(p) AS n_scored, COUNT(*) - COUNT(p) AS n_dropped,
  ROUND(SUM(CASE WHEN p IS NOT NULL THEN {W} * abs(y - p) END)
        / SUM(CASE WHEN p IS NOT NULL THEN {W} END) / 100.0, 4) AS wmae
FROM val GROUP BY 1, 2, 3""", covers="J1 C14 C4 D12 D14")
def q_seasonal_naive_cv(spark, sf):
    return seasonal_naive_cv(spark, sf)


def seasonal_naive_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship (M0): panel -> folds -> prior-year value as the forecast -> WMAE
    per fold, rows without a forecast counted."""
    m = with_cents(panel(spark, sf))
    # errors on integer cents: exact, order-independent sums
    feats = FE.add_prior_year_sales(m, target="cents", out="prior_cents")
    folds = SP.walk_forward_folds(m)
    val = SP.assign_folds(feats, folds).filter(F.col("role") == "val")
    has = F.col("prior_cents").isNotNull()
    w = holiday_weight("is_holiday")
    err = F.abs(F.col("cents") - F.col("prior_cents"))
    return val.groupBy("fold", "val_start", "val_end").agg(
        F.count(F.lit(1)).alias("n_val"), F.count_if(has).alias("n_scored"),
        F.count_if(~has).alias("n_dropped"),
        r4(F.sum(F.when(has, w * err)) / F.sum(F.when(has, w)) / 100.0, "wmae"))


def _spread_sql() -> str:
    vals = ", ".join(f"('{n}', DATE '{d}')" for n, d in PANEL_HOLIDAYS)
    return PANEL_SQL + f""", cal AS (SELECT * FROM (VALUES {vals}) t(name, hdate)),
sp AS (SELECT name, CAST(hdate + CAST(o.off AS INTEGER) AS DATE) AS ds, CAST(o.off AS INTEGER) AS "offset"
       FROM cal, range(-7, 1) o(off))
SELECT d.date, sp.name, sp."offset" FROM (SELECT DISTINCT date FROM panel) d JOIN sp ON d.date = sp.ds"""


@register("holiday_window_rows", _spread_sql(), covers="H17")
def q_holiday_window_rows(spark, sf):
    from ..functions.calendar import holiday_frame, spread_holidays
    sp = spread_holidays(holiday_frame(spark, PANEL_HOLIDAYS))
    d = lazy_panel(spark, sf).select("date").distinct()
    # the spread calendar is parameter-sized (holidays x window width)
    return d.join(F.broadcast(sp), d.date == sp.ds).select("date", "name", "offset")


@register("calendar_parts", PANEL_SQL + """SELECT DISTINCT date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week FROM panel""", covers="H2")
def q_calendar_parts(spark, sf):
    from ..functions.calendar import calendar_parts
    d = lazy_panel(spark, sf).select("date").distinct()
    return d.select("date", *[c.alias(k) for k, c in calendar_parts("date").items()])
