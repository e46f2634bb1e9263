"""Evaluation, fallback and search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import compare_models, mean_and_median, wmae_by, wmae_expr
from ..operators import fallback as FB
from ..operators import features as FE
from ..operators import splits as SP
from ..operators import windows as WN
from ..session import materialize
from ..sources import testpanel as TP
from . import sqlparts as Q
from .catalog import r4, r4_cols, register
from .q_core import PANEL_SQL, W, _folds_sql, panel, seasonal_naive_cv, with_cents

BRAND_SPLIT = Q.with_(Q.panel_cte("brand")) + ", " + Q.split_ctes() + """,
tc AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM train),
stats AS (SELECT store, dept, COUNT(*) AS n, AVG(cents) AS m FROM tc GROUP BY 1, 2),
gm AS (SELECT AVG(cents) AS g FROM tc),
steps AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS step FROM (SELECT DISTINCT date FROM test)),
last52 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, dept ORDER BY date DESC) AS rk FROM tc)
           WHERE rk <= 52),
iw AS (SELECT store, dept, CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mu FROM last52 GROUP BY 1, 2),
casc AS (SELECT t.store, t.dept, t.date, t.is_holiday,
  CASE WHEN COALESCE(s.n, 0) >= 52 AND iw.mu IS NOT NULL THEN iw.mu WHEN COALESCE(s.n, 0) > 0 THEN s.m
       ELSE (SELECT g FROM gm) END AS p,
  CASE WHEN COALESCE(s.n, 0) >= 52 AND iw.mu IS NOT NULL THEN 'model' WHEN COALESCE(s.n, 0) > 0 THEN 'series_mean'
       ELSE 'global_mean' END AS source
  FROM test t JOIN steps st ON t.date = st.date LEFT JOIN stats s ON t.store = s.store AND t.dept = s.dept
  LEFT JOIN iw ON t.store = iw.store AND t.dept = iw.dept)
"""


def _brand_split(spark: SparkSession, sf: str):
    return TP.train_test_split(with_cents(panel(spark, sf, "brand")))


def window_mean_model(history: DataFrame, horizon: int, target: str = "cents") -> DataFrame:
    """A global "model" for the cascade: mean of the last 52 values, every step."""
    w = WN.inference_windows(history, 52, target=target)
    return w.select("store", "dept", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("step"),
                    WN.array_mean(F.col("x")).alias("y_model"))


def cascade(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _brand_split(spark, sf)
    model = window_mean_model(train, TP.TEST_WEEKS)
    c = FB.fallback_cascade(test, train, model, target="cents")
    return c.withColumn("y_pred", F.col("y_pred") / 100.0)


@register("fallback_cascade", BRAND_SPLIT + """SELECT store, dept, date,
  ROUND(CASE WHEN p < 0 THEN 0 ELSE p END / 100.0, 4) AS y_pred, source FROM casc""",
          covers="K13 D18 H10 T16 T20 I11")
def q_cascade(spark, sf):
    return cascade(spark, sf).select("store", "dept", "date", r4("y_pred"), "source")


@register("fallback_rate", BRAND_SPLIT + """, per AS (SELECT store, dept, MAX(CASE WHEN source <> 'model' THEN 1 ELSE 0 END)
  AS fb FROM casc GROUP BY 1, 2)
SELECT COUNT(*) AS n_series, COUNT(*) FILTER (WHERE fb = 1) AS n_fallback, ROUND(AVG(CAST(fb AS DOUBLE)), 4)
  AS fallback_rate FROM per""", covers="D21")
def q_fallback_rate(spark, sf):
    return r4_cols(FB.fallback_rate(cascade(spark, sf)), ["fallback_rate"])


@register("prediction_stats", BRAND_SPLIT + """SELECT ROUND(AVG(CASE WHEN p < 0 THEN 0 ELSE p END) / 100.0, 4)
  AS mean_prediction, COUNT(*) AS n_predictions FROM casc""", covers="D22")
def q_prediction_stats(spark, sf):
    c = cascade(spark, sf)
    return c.agg(r4(F.avg(F.col("y_pred") * 100) / 100.0, "mean_prediction"),
                 F.count(F.lit(1)).alias("n_predictions"))


@register("submission", BRAND_SPLIT + """SELECT CAST(store AS VARCHAR) || '_' || CAST(dept AS VARCHAR) || '_' ||
  strftime(date, '%Y-%m-%d') AS Id, ROUND(CASE WHEN p < 0 THEN 0 ELSE p END / 100.0, 4) AS Weekly_Sales FROM casc""",
          covers="H5 H3 A3")
def q_submission(spark, sf):
    c = cascade(spark, sf).withColumn("y_pred", r4("y_pred"))
    return FB.submission_frame(c)


@register("prediction_lookup", BRAND_SPLIT + """, m AS (SELECT iw.store, iw.dept, s.date, iw.mu FROM iw, steps s)
SELECT t.store, t.dept, t.date, ROUND(COALESCE(m.mu, 0.0) / 100.0, 4) AS y_pred, m.mu IS NULL AS is_missing
FROM test t LEFT JOIN m ON t.store = m.store AND t.dept = m.dept AND t.date = m.date""", covers="C9 K14")
def q_prediction_lookup(spark, sf):
    train, test = _brand_split(spark, sf)
    steps = FB.step_positions(test)
    m = window_mean_model(train, TP.TEST_WEEKS).join(steps, "step").select("store", "dept", "date", "y_model")
    out = FB.lookup_predictions(test, m, pred="y_model")
    return out.select("store", "dept", "date", r4(F.col("y_model") / 100.0, "y_pred"), "is_missing")


# ---- scoring: seasonal naive vs last value on a 13-week holdout ------------

HOLDOUT_SQL = PANEL_SQL + f""", c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
cut AS (SELECT MAX(date) - 91 AS c FROM panel),
prior AS (SELECT store, dept, CAST(year(date) + 1 AS INTEGER) AS y, CAST(week(date) AS INTEGER) AS wk,
          AVG(cents) AS p FROM c GROUP BY 1, 2, 3, 4),
lastv AS (SELECT store, dept, arg_max(cents, date) AS lv FROM c, cut WHERE date <= cut.c GROUP BY 1, 2),
val AS (SELECT p.store, p.dept, p.date, p.is_holiday, p.cents AS y, r.p AS seasonal_naive, l.lv AS last_value
        FROM c p JOIN cut ON p.date > cut.c
        LEFT JOIN prior r ON r.store = p.store AND r.dept = p.dept AND r.y = CAST(year(p.date) AS INTEGER)
             AND r.wk = CAST(week(p.date) AS INTEGER)
        LEFT JOIN lastv l ON l.store = p.store AND l.dept = p.dept),
scores AS (
  SELECT store, dept, 'seasonal_naive' AS model, SUM({W} * abs(y - seasonal_naive)) / SUM({W}) / 100.0 AS wmae,
    COUNT(*) AS n_rows FROM val WHERE seasonal_naive IS NOT NULL GROUP BY 1, 2
  UNION ALL
  SELECT store, dept, 'last_value' AS model, SUM({W} * abs(y - last_value)) / SUM({W}) / 100.0 AS wmae,
    COUNT(*) AS n_rows FROM val WHERE last_value IS NOT NULL GROUP BY 1, 2)
"""


def holdout_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Per-series WMAE of two baseline forecasts on the last 13 weeks (rows with a forecast).

    Computed on integer cents, so error sums are exact and order-independent.
    """
    p = with_cents(panel(spark, sf))
    train, val = SP.holdout_last_weeks(p, 13)
    val = FE.add_prior_year_sales(val, history=p, target="cents", out="seasonal_naive")
    last = train.groupBy("store", "dept").agg(F.max_by("cents", "date").alias("last_value"))
    val = val.join(last, ["store", "dept"], "left")
    out = None
    for m in ("seasonal_naive", "last_value"):
        s = (wmae_by(val.filter(F.col(m).isNotNull()), ["store", "dept"], "cents", m)
             .withColumn("wmae", F.col("wmae") / 100.0).withColumn("model", F.lit(m)))
        out = s if out is None else out.unionByName(s)
    return out


@register("wmae_per_series", HOLDOUT_SQL + """SELECT store, dept, model, ROUND(wmae, 4) AS wmae, n_rows FROM scores""",
          covers="D12 D13 J2 C4 H6 H7 L8")
def q_wmae_per_series(spark, sf):
    return r4_cols(holdout_scores(spark, sf), ["wmae"])


@register("wmae_summary", HOLDOUT_SQL + """SELECT model, ROUND(AVG(wmae), 4) AS mean_wmae, ROUND(MEDIAN(wmae), 4)
  AS median_wmae FROM scores GROUP BY 1""", covers="D15")
def q_wmae_summary(spark, sf):
    s = materialize(holdout_scores(spark, sf))
    return r4_cols(mean_and_median(s, "wmae", by=["model"]), ["mean_wmae", "median_wmae"])


@register("model_comparison", HOLDOUT_SQL + """, wide AS (SELECT store, dept,
  MAX(CASE WHEN model = 'last_value' THEN wmae END) AS last_value,
  MAX(CASE WHEN model = 'seasonal_naive' THEN wmae END) AS seasonal_naive FROM scores GROUP BY 1, 2)
SELECT store, dept, ROUND(last_value, 4) AS last_value, ROUND(seasonal_naive, 4) AS seasonal_naive,
  ROUND(CASE WHEN last_value <> 0 THEN (last_value - seasonal_naive) / last_value END * 100, 4) AS improvement_pct
FROM wide""", covers="D24 H15")
def q_model_comparison(spark, sf):
    c = compare_models(holdout_scores(spark, sf), ["store", "dept"], "model", "wmae", "last_value", "seasonal_naive")
    return r4_cols(c, ["last_value", "seasonal_naive", "improvement_pct"])


@register("best_model_per_series", HOLDOUT_SQL + """SELECT store, dept, arg_min(model, (wmae, model)) AS best_model,
  ROUND(MIN(wmae), 4) AS best_wmae FROM scores GROUP BY 1, 2""", covers="F6")
def q_best_model(spark, sf):
    s = holdout_scores(spark, sf)
    return s.groupBy("store", "dept").agg(F.min_by("model", F.struct("wmae", "model")).alias("best_model"),
                                          r4(F.min("wmae"), "best_wmae"))


@register("mean_fold_wmae", PANEL_SQL + ", " + _folds_sql() + f""",
c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
prior AS (SELECT store, dept, CAST(year(date) + 1 AS INTEGER) AS y, CAST(week(date) AS INTEGER) AS wk,
          AVG(cents) AS p FROM c GROUP BY 1, 2, 3, 4),
val AS (SELECT f.fold, p.is_holiday, p.cents AS y, r.p FROM c p JOIN folds f
        ON p.date BETWEEN f.val_start AND f.val_end LEFT JOIN prior r ON r.store = p.store AND r.dept = p.dept
        AND r.y = CAST(year(p.date) AS INTEGER) AND r.wk = CAST(week(p.date) AS INTEGER)),
per AS (SELECT fold, ROUND(SUM(CASE WHEN p IS NOT NULL THEN {W} * abs(y - p) END)
        / SUM(CASE WHEN p IS NOT NULL THEN {W} END) / 100.0, 4) AS wmae FROM val GROUP BY 1)
SELECT ROUND(AVG(wmae), 4) AS mean_wmae, COUNT(*) AS n_folds FROM per""", covers="D14")
def q_mean_fold_wmae(spark, sf):
    per = seasonal_naive_cv(spark, sf)
    return per.agg(r4(F.avg("wmae"), "mean_wmae"), F.count(F.lit(1)).alias("n_folds"))


# ---- a parameter search expressed as one Spark job (K8 shape, F5) ---------

TRIAL_WINDOWS = (4, 8, 13, 26, 52)


def rolling_mean_trials(spark: SparkSession, sf: str) -> DataFrame:
    """Mean fold WMAE of the one-step rolling-mean forecast for each window length.

    All trials are columns of one window projection over the panel, then one
    unpivot and one aggregate: the search is a single job, not a driver loop.
    """
    p = with_cents(panel(spark, sf))
    w = FE.series_window()
    cols = [(F.avg("cents").over(w.rowsBetween(-k, -1)) / 100.0).alias(f"k{k}") for k in TRIAL_WINDOWS]
    f = p.select("store", "dept", "date", "weekly_sales", "is_holiday", *cols)
    long = f.unpivot(["store", "dept", "date", "weekly_sales", "is_holiday"], [f"k{k}" for k in TRIAL_WINDOWS],
                     "trial", "y_pred").withColumn("win_len", F.expr("cast(substring(trial, 2) as int)"))
    val = SP.assign_folds(long, SP.walk_forward_folds(p)).filter(F.col("role") == "val")
    per = val.filter(F.col("y_pred").isNotNull()).groupBy("win_len", "fold").agg(
        wmae_expr("weekly_sales", "y_pred").alias("wmae"))
    return per.groupBy("win_len").agg(r4(F.avg("wmae"), "mean_wmae"), F.count(F.lit(1)).alias("n_folds"))


def _trials_sql() -> str:
    cols = ", ".join(f"AVG(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN {k} PRECEDING AND "
                     f"1 PRECEDING) / 100.0 AS k{k}" for k in TRIAL_WINDOWS)
    unions = " UNION ALL ".join(f"SELECT store, dept, date, weekly_sales, is_holiday, {k} AS win_len, k{k} AS y_pred "
                                f"FROM f" for k in TRIAL_WINDOWS)
    return PANEL_SQL + ", " + _folds_sql() + f""",
c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
f AS (SELECT store, dept, date, weekly_sales, is_holiday, {cols} FROM c),
lng AS ({unions}),
per AS (SELECT l.win_len, fo.fold, SUM({W} * abs(l.weekly_sales - l.y_pred)) / SUM({W}) AS wmae
        FROM lng l JOIN folds fo ON l.date BETWEEN fo.val_start AND fo.val_end
        WHERE l.y_pred IS NOT NULL GROUP BY 1, 2),
trials AS (SELECT CAST(win_len AS INTEGER) AS win_len, ROUND(AVG(wmae), 4) AS mean_wmae, COUNT(*) AS n_folds
           FROM per GROUP BY 1)
"""


@register("rolling_mean_trials", _trials_sql() + "SELECT * FROM trials", covers="D14")
def q_trials(spark, sf):
    return rolling_mean_trials(spark, sf)


@register("best_trial", _trials_sql() + """SELECT arg_min(win_len, (mean_wmae, win_len)) AS best_window,
  MIN(mean_wmae) AS best_mean_wmae FROM trials""", covers="F5")
def q_best_trial(spark, sf):
    t = rolling_mean_trials(spark, sf)
    return t.agg(F.min_by("win_len", F.struct("mean_wmae", "win_len")).alias("best_window"),
                 F.min("mean_wmae").alias("best_mean_wmae"))
