"""Model and per-series diagnostic queries.

Iterative model fits (boosted trees, per-step ridge, per-series additive
fits) have no SQL equivalent and are checked by rows only (and in tests).
Closed-form fits and diagnostics carry oracle SQL: the per-series AR(1)
walk-forward (simple regression + recursive-CTE forecast), lag-0 and k-lag
Dickey-Fuller and the AR order grid through determinant ratios of centred
cross-product matrices, ACF, PACF through a recursive CTE, seasonal
decomposition, and the calendar / sampling operators.
"""

from __future__ import annotations

import json
import math
import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import holiday_frame
from ..functions.metrics import compare_models, holiday_weight, mean_and_median, wmae_by, wmae_expr
from ..models import additive as AD
from ..models import ar as AR
from ..models import boosting as BO
from ..models import builder as B
from ..models import changes as CH
from ..models import diagnostics as DG
from ..models import linear as LN
from ..models import trees as T
from ..operators import fallback as FB
from ..operators import splits as SP
from ..operators.grid import densify_ffill
from ..operators import windows as WN
from ..session import ensure_checkpoint_dir, materialize
from ..sources import sinks as SK
from ..sources.schemas import RENAME
from ..sources import testpanel as TP
from . import sqlparts as Q
from .catalog import ORACLE, r4, r4_cols, register
from .q_core import PANEL_HOLIDAYS, panel, lazy_panel


def _region(spark, sf):
    return (panel(spark, sf, "region"), TP.features_table(spark, sf, "region"),
            TP.stores_table(spark, sf, "region"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder (never machine-local)."""
    return os.path.join(ensure_checkpoint_dir(spark), "panelcast", f"{name}-{uuid.uuid4().hex[:12]}")


# ---- trees ----------------------------------------------------------------

_ENCODE_SQL = Q.with_(Q.panel_cte("region"), Q.stores_cte("region")) + """,
d AS (SELECT DISTINCT p.store, p.dept, s.type FROM panel p LEFT JOIN stores s ON p.store = s.store)
SELECT store, dept, type,
  CAST(DENSE_RANK() OVER (ORDER BY CAST(store AS VARCHAR)) - 1 AS DOUBLE) AS store__idx,
  CAST(DENSE_RANK() OVER (ORDER BY CAST(dept AS VARCHAR)) - 1 AS DOUBLE) AS dept__idx,
  CAST(DENSE_RANK() OVER (ORDER BY type) - 1 AS DOUBLE) AS type__idx FROM d"""


@register("encode_categories", _ENCODE_SQL, covers="K1 H16 T21")
def q_encode(spark, sf):
    p, f, s = _region(spark, sf)
    t = B.feature_table(p, f, s, PANEL_HOLIDAYS)
    stages = T.encoding_stages(["store", "dept", "type", "size"])
    m = stages[1].fit(stages[0].transform(t))
    out = m.transform(stages[0].transform(t))
    return out.select("store", "dept", "type", "store__idx", "dept__idx", "type__idx").distinct()


def _at_region(sql: str) -> str:
    """The same SQL over the region grain."""
    for cte in (Q.panel_cte, Q.features_cte, Q.stores_cte):
        sql = sql.replace(cte("nation"), cte("region"))
    return sql


def _checked_table_sql(columns: list[str]) -> str:
    flag = lambda n: f"date IN ({', '.join(chr(39) + d + chr(39) + '::DATE' for h, d in PANEL_HOLIDAYS if h == n)}) AS is_{n}"
    mean = lambda c: f"floor({c} * 100 + 0.5) / 100 AS {c}"
    own = {"year": "CAST(year(date) AS INTEGER) AS year", "month": "CAST(month(date) AS INTEGER) AS month", "week": "CAST(week(date) AS INTEGER) AS week",
           "dept_avg_sales_expanding": mean("dept_avg_sales_expanding"), "store_avg_sales_expanding": mean("store_avg_sales_expanding")}
    own |= {f"is_{n}": flag(n) for n in ("superbowl", "labor_day", "thanksgiving", "christmas")}
    parts = ["clean_data", "prior_year_lag", "expanding_dept_avg", "expanding_store_avg"]
    lag = f"SELECT store, dept, date, sales_lag_52wk FROM ({ORACLE['prior_year_lag']})"
    tables = [f"({lag if p == 'prior_year_lag' else ORACLE[p]})" for p in parts]
    return ("SELECT date, " + ", ".join(own.get(c, c) for c in columns) + " FROM " + tables[0]
            + "".join(f" JOIN {t} USING (store, dept, date)" for t in tables[1:]) + f" JOIN ({ORACLE['holiday_proximity']}) USING (date)")


def _checked(t: DataFrame, columns: list[str]) -> DataFrame:
    """Averages to cents, flags as booleans, other numbers to 4 places."""
    def out(c):
        if c.endswith("_expanding"):
            return (F.floor(r4(c) * 100 + 0.5) / 100).alias(c)
        if c.startswith("is_"):
            return F.col(c).cast("boolean").alias(c)
        return r4(c) if t.schema[c].dataType.simpleString() == "double" else F.col(c)
    return t.select("date", *[out(c) for c in columns])


@register("feature_table_checked", _checked_table_sql(B.ALL_FEATURES), covers="B15 C4 C5 C11 E4 E5 H2 H11 H12")
def q_feature_table_checked(spark, sf):
    """The 24-column table at nation grain."""
    return _checked(B.feature_table(panel(spark, sf), TP.features_table(spark, sf), TP.stores_table(spark, sf), PANEL_HOLIDAYS), B.ALL_FEATURES)


@register("feature_table_all", _at_region(_checked_table_sql(B.ALL_FEATURES)), covers="B15 C11 H12 H2")
def q_feature_table(spark, sf):
    p, f, s = _region(spark, sf)
    return _checked(B.feature_table(p, f, s, PANEL_HOLIDAYS), B.ALL_FEATURES)


@register("feature_table_pruned", _at_region(_checked_table_sql(B.PRUNED_FEATURES)), covers="B15")
def q_feature_table_pruned(spark, sf):
    p, f, s = _region(spark, sf)
    return _checked(B.feature_table(p, f, s, PANEL_HOLIDAYS), B.PRUNED_FEATURES)


def _frozen_sql() -> str:
    """Serving features of the withheld weeks from all history before them (cents averages over exact sums)."""
    split = f"cut AS (SELECT MAX(date) - {7 * TP.TEST_WEEKS} AS c FROM panel), train AS (SELECT p.* FROM panel p, cut WHERE p.date <= cut.c)"
    def frozen(g):
        return f"""{g}_d AS (SELECT {g}, date, AVG(cents) AS m FROM tc GROUP BY 1, 2),
{g}_r AS (SELECT {g}, m, row_number() OVER (PARTITION BY {g} ORDER BY date DESC) AS rn, COUNT(*) OVER (PARTITION BY {g}) AS n FROM {g}_d),
{g}_s AS (SELECT {g}, AVG(m) / 100.0 AS v FROM {g}_r WHERE rn > 1 OR n = 1 GROUP BY 1)"""
    last = lambda c: f"last_value({c} IGNORE NULLS) OVER (PARTITION BY t.store ORDER BY t.date, t.dept ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    day = ", ".join(f"DATE '{d}'" for n, d in PANEL_HOLIDAYS if n == "thanksgiving")
    return Q.with_(Q.panel_cte("nation"), Q.features_cte("nation"), Q.stores_cte("nation"), split) + f""",
tc AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM train),
hist AS (SELECT store, dept, year(date) + 1 AS y, week(date) AS wk, AVG(cents) / 100.0 AS lag52 FROM tc GROUP BY 1, 2, 3, 4),
{frozen("dept")},
{frozen("store")},
c AS (SELECT t.store, t.dept, t.date, s.type, s.size, f.temperature, f.fuel_price, {last("f.cpi")} AS cpi, {last("f.unemployment")} AS unemployment,
  COALESCE(f.markdown3, 0) AS markdown3
  FROM panel t JOIN cut ON t.date > cut.c LEFT JOIN features f ON t.store = f.store AND t.date = f.date LEFT JOIN stores s ON t.store = s.store)
SELECT c.store, c.dept, c.date, c.type, c.size, ROUND(c.temperature, 4) AS temperature, ROUND(c.fuel_price, 4) AS fuel_price, ROUND(c.cpi, 4) AS cpi,
  ROUND(c.unemployment, 4) AS unemployment, ROUND(c.markdown3, 4) AS markdown3, CAST(month(c.date) AS INTEGER) AS month, CAST(week(c.date) AS INTEGER) AS week,
  ROUND(h.lag52, 4) AS sales_lag_52wk, c.date IN ({day}) AS is_thanksgiving, {Q.nearest_holiday_sql("c.date", PANEL_HOLIDAYS)} AS days_to_nearest_holiday,
  ROUND(ds.v, 4) AS dept_avg_sales_expanding, ROUND(ss.v, 4) AS store_avg_sales_expanding
FROM c LEFT JOIN hist h ON h.store = c.store AND h.dept = c.dept AND h.y = year(c.date) AND h.wk = week(c.date)
  LEFT JOIN dept_s ds ON ds.dept = c.dept LEFT JOIN store_s ss ON ss.store = c.store"""


def _updated_builder(spark, sf):
    """A builder fitted on the older train weeks and updated twice with newer ones, in cents; and the withheld weeks."""
    train, test = TP.train_test_split(panel(spark, sf), unseen=None)
    cents = train.withColumn("weekly_sales", (F.round(F.col("weekly_sales") * 100)).cast("double"))
    last = train.agg(F.max("date")).scalar()
    age = F.datediff(last, F.col("date"))
    builder = B.PanelFeatureBuilder(features=TP.features_table(spark, sf), stores=TP.stores_table(spark, sf), holidays=json.dumps(PANEL_HOLIDAYS))
    model = builder.fit(cents.filter(age >= 7 * 52))
    return model.update(cents.filter((age < 7 * 52) & (age >= 7 * 10))).update(cents.filter(age < 7 * 10)), test


def _frozen_out(t: DataFrame) -> DataFrame:
    money = ["sales_lag_52wk", "dept_avg_sales_expanding", "store_avg_sales_expanding"]
    own = {c: r4(F.col(c) / 100, c) for c in money} | {"is_thanksgiving": F.col("is_thanksgiving").cast("boolean").alias("is_thanksgiving")}
    own |= {c: r4(c) for c in ("temperature", "fuel_price", "cpi", "unemployment", "markdown3")}
    return t.select("date", *[own.get(c, F.col(c)) for c in B.PRUNED_FEATURES])


@register("builder_frozen_features", _frozen_sql(), covers="K2 T8 C6 D19 L5")
def q_builder_frozen(spark, sf):
    """Serving features of the withheld weeks: a state fitted on old weeks and updated with new ones equals one over all history."""
    model, test = _updated_builder(spark, sf)
    return _frozen_out(model.transform(test))


@register("saved_builder_parity", _frozen_sql(), covers="A6 K11 L6")
def q_saved_builder(spark, sf):
    """The same from a saved and reloaded pipeline."""
    model, test = _updated_builder(spark, sf)
    path = shared_path(spark, "builder")
    PipelineModel(stages=[model]).write().save(path)
    return _frozen_out(PipelineModel.load(path).transform(test))


def _gbt_cv(spark, sf, features):
    p, f, s = _region(spark, sf)
    return T.cv_flat(B.feature_table(p, f, s, PANEL_HOLIDAYS), SP.walk_forward_folds(p), features, T.PRESET_QUICK, parallel=3)


@register("gbt_walk_forward_cv", None, covers="K4 K6 D14 T17")
def q_gbt_cv(spark, sf):
    scores, _ = _gbt_cv(spark, sf, B.PRUNED_FEATURES)
    return scores


# Patience of the registered preset queries (the library default is 50 trees).
QUICK_PATIENCE = 10


def _preset_cv(spark, sf, preset):
    p, f, s = _region(spark, sf)
    return BO.cv_with_patience(B.feature_table(p, f, s, PANEL_HOLIDAYS), SP.walk_forward_folds(p), B.PRUNED_FEATURES, preset,
                               patience=QUICK_PATIENCE, stop_weeks=13, parallel=3)


@register("gbt_leafwise_preset_cv", None, covers="K4 D14 T17")
def q_gbt_leafwise(spark, sf):
    """The first reported parameter set whole (659 trees at most), cut at its best prefix on the newest 13 train weeks."""
    return _preset_cv(spark, sf, T.PRESET_LEAFWISE)[0]


@register("gbt_histogram_preset_cv", None, covers="K5 D14 T17")
def q_gbt_histogram(spark, sf):
    """The second reported parameter set (385 trees at most), cut at its best prefix on the newest 13 train weeks."""
    return _preset_cv(spark, sf, T.PRESET_HISTOGRAM)[0]


@register("gbt_patience_path", None, covers="K4 K5")
def q_gbt_patience_path(spark, sf):
    """Slice error of every prefix looked at, and which one was kept, per fold."""
    return _preset_cv(spark, sf, T.PRESET_LEAFWISE)[1]


@register("gbt_feature_importance", None, covers="K7 D20 F3 A4")
def q_gbt_importance(spark, sf):
    _, imps = _gbt_cv(spark, sf, B.ALL_FEATURES)
    path = shared_path(spark, "importance")
    SK.write_importances(imps.orderBy(F.desc("importance"), "feature"), path)
    return spark.read.option("header", True).schema("feature string, importance double").csv(path)


def _fold_sums_sql() -> str:
    from .q_core import _folds_sql
    return Q.with_(Q.panel_cte("region")) + ", " + _folds_sql() + f"""
SELECT CAST(fold AS INTEGER) AS fold, CAST({len(B.ALL_FEATURES)} AS BIGINT) AS n_features, CAST(1.0 AS DOUBLE) AS total FROM folds"""


def _importances(spark, sf):
    p, f, s = _region(spark, sf)
    return BO.fold_importances(B.feature_table(p, f, s, PANEL_HOLIDAYS), SP.walk_forward_folds(p), B.ALL_FEATURES, T.PRESET_QUICK, parallel=3)


@register("importance_fold_sums", _fold_sums_sql(), covers="K7 D20")
def q_importance_sums(spark, sf):
    """Every feature has one row per fold, and a fold's importances add up to one."""
    return _importances(spark, sf).groupBy("fold").agg(F.count("feature").alias("n_features"), r4(F.sum("importance"), "total"))


@register("features_by_importance", None, covers="K7 B15 F3")
def q_pruned_features(spark, sf):
    """The pruning step: the 16 of 24 features with the largest importance summed over the folds."""
    return BO.prune_features(_importances(spark, sf), len(B.PRUNED_FEATURES))


def _encoded_rows_sql(stop_weeks: int = 13) -> str:
    from .q_core import _folds_sql
    return Q.with_(Q.panel_cte("region")) + ", " + _folds_sql() + f""",
l AS (SELECT p.*, h.store IS NULL AS no_lag, CAST(ROUND(p.weekly_sales * 100) AS BIGINT) AS cents FROM panel p
  LEFT JOIN panel h ON h.store = p.store AND h.dept = p.dept AND year(h.date) + 1 = year(p.date) AND week(h.date) = week(p.date)),
j AS (SELECT l.*, f.fold, CASE WHEN l.date >= f.val_start THEN 'val'
    WHEN l.date > (SELECT MAX(date) FROM panel q WHERE q.date < f.val_start) - {7 * stop_weeks} THEN 'stop' ELSE 'train' END AS part
  FROM l JOIN folds f ON l.date <= f.val_end)
SELECT CAST(fold AS INTEGER) AS fold, part, COUNT(*) AS n, CAST(SUM(CASE WHEN is_holiday THEN 5 ELSE 1 END) AS BIGINT) AS weight,
  CAST(SUM(cents) AS BIGINT) AS cents, COUNT(*) FILTER (no_lag) AS n_missing_lag FROM j GROUP BY 1, 2"""


@register("encoded_fold_rows", _encoded_rows_sql(), covers="K1 K4 K5 K6 J1")
def q_encoded_rows(spark, sf):
    """The stored training tables of the folds: rows, holiday weights and labels per part, and the missing flags in the feature vectors."""
    p, f, s = _region(spark, sf)
    at = T.assembled_names(B.PRUNED_FEATURES).index("sales_lag_52wk__missing")
    parts = []
    for e in BO.encode_folds(B.feature_table(p, f, s, PANEL_HOLIDAYS), SP.walk_forward_folds(p), B.PRUNED_FEATURES, 13):
        missing = F.sum(vector_to_array("features")[at]).cast("long")
        parts.append(e.table.groupBy(F.lit(e.fold).alias("fold"), "part").agg(
            F.count(F.lit(1)).alias("n"), F.sum(holiday_weight("is_holiday")).cast("long").alias("weight"),
            F.sum(F.round(F.col("weekly_sales") * 100).cast("long")).alias("cents"), missing.alias("n_missing_lag")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("gbt_pipeline_newest_fold", None, covers="K2 K9 T8 T13 L5 C6")
def q_gbt_pipeline(spark, sf):
    p, f, s = _region(spark, sf)
    folds = SP.walk_forward_folds(p).orderBy(F.desc("fold")).limit(1)
    return T.cv_pipeline(p, folds, B.PanelFeatureBuilder(features=f, stores=s, holidays=json.dumps(PANEL_HOLIDAYS)), B.PRUNED_FEATURES, T.PRESET_QUICK)


# The registered search starts the reference's 30 trials, of 12 to 24 trees each (the library default is 100 to 800).
SEARCH_TREES = {"maxIter": (12, 24)}


@register("gbt_random_search", None, covers="K8 F5 A5")
def q_gbt_search(spark, sf):
    """Successive halving of 30 trials; every trial's rungs and parameters go to the run log, which is read back."""
    p, f, s = _region(spark, sf)
    trials = BO.halving_search(B.feature_table(p, f, s, PANEL_HOLIDAYS), SP.walk_forward_folds(p), B.PRUNED_FEATURES,
                               n_trials=30, seed=42, parallel=8, space=SEARCH_TREES)
    log = shared_path(spark, "runlog")
    SK.log_params(trials.select(F.concat(F.lit("trial_"), "trial").alias("run"), "params").distinct(), log, "run", "params")
    for rung in range(BO.RUNGS):
        SK.log_runs(trials.filter(F.col("rung") == rung).select(F.concat(F.lit("trial_"), "trial").alias("run"), "mean_wmae", "n_trees", F.col("kept").cast("double").alias("kept")),
                    log, "run", {c: f"{c}_rung{rung}" for c in ("mean_wmae", "n_trees", "kept")})
    metrics = SK.run_summary(spark, log, "metric", [f"{c}_rung{r}" for r in range(BO.RUNGS) for c in ("mean_wmae", "n_trees", "kept")])
    return metrics.join(SK.run_summary(spark, log, "param", sorted(T.SEARCH_SPACE)), "run")


@register("gbt_forecast_saved_model", None, covers="K10 K11 A6 A3 H10 H5 L6")
def q_gbt_forecast(spark, sf):
    p, f, s = _region(spark, sf)
    train, test = TP.train_test_split(p, unseen=None)
    model, pred = T.refit_and_predict(train, test, B.PanelFeatureBuilder(features=f, stores=s, holidays=json.dumps(PANEL_HOLIDAYS)),
                                      B.PRUNED_FEATURES, T.PRESET_QUICK)
    path = shared_path(spark, "gbt-model")
    model.write().overwrite().save(path)
    scored = T.score_saved(path, test)
    out = shared_path(spark, "submission")
    SK.write_forecast(FB.submission_frame(scored), out)
    return spark.read.option("header", True).schema("Id string, Weekly_Sales double").csv(out)


# ---- global linear model on windows ----------------------------------------

@register("dlinear_gram", Q.with_(Q.panel_cte("nation")) + """, c AS (SELECT store, dept, date, is_holiday, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents FROM panel),
t AS (SELECT row_number() OVER (PARTITION BY store, dept ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY store, dept) AS n,
  list(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING) AS x,
  list(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS y,
  list(is_holiday) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS h FROM c),
s AS (SELECT x, unnest(range(0, 13)) AS step, unnest(y) AS y, unnest([CASE WHEN f THEN 5 ELSE 1 END FOR f IN h]) AS w
  FROM t WHERE n >= 78 AND rn > 52 AND rn + 12 <= n - 13),
e AS (SELECT step, unnest(range(1, 53)) AS lag, unnest(list_reverse(x)) AS x, y, w FROM s)
SELECT CAST(step AS INTEGER) AS step, CAST(lag AS INTEGER) AS lag, CAST(SUM(w) AS DOUBLE) AS weight,
  ROUND(SUM(CAST(w * x AS DOUBLE) * y) / SUM(w) / 1e12, 4) AS xy FROM e GROUP BY 1, 2""", covers="K12 I8 T11")
def q_dlinear_gram(spark, sf):
    """Weighted moments between each lag and each horizon step, the sums the model is solved from; cents products over 1e12."""
    cents = lazy_panel(spark, sf).withColumn("cents", F.round(F.col("weekly_sales") * 100).cast("bigint"))
    windows = WN.build_windows(cents, 52, 13, 13, target="cents")
    rows = [(s, 52 - j, float(g[0, 0]), float(g[1 + j, -1] / g[0, 0] / 1e12))
            for s, g in enumerate(LN.weighted_moments(LN.window_moments(windows, 13), 13)) for j in range(52)]  # 13 * 52 sums
    return r4_cols(spark.createDataFrame(rows, "step int, lag int, weight double, xy double"), ["xy"])


def _dlinear_val(spark, sf):
    p = panel(spark, sf, "region")
    train_w = WN.build_windows(p, 52, 13, 13)
    coefs = LN.fit_direct(train_w, 13, reg=0.1)
    val_w = WN.validation_windows(p, 52, 13, 13)
    return LN.score_windows(LN.predict_windows(val_w, coefs))


@register("dlinear_validation_wmae", None, covers="K12 I6 I7 I8 I9 D12 D13")
def q_dlinear_val(spark, sf):
    s = _dlinear_val(spark, sf)
    return wmae_by(s, ["store", "dept"])


@register("dlinear_scores", None, covers="K12 D12 D14")
def q_dlinear_scores(spark, sf):
    """WMAE over all validation rows, and mean and median of the series' own."""
    s = materialize(_dlinear_val(spark, sf))
    per_series = wmae_by(s, ["store", "dept"])
    return mean_and_median(per_series).select(
        s.agg(wmae_expr("y", "y_pred")).scalar().alias("total_wmae"), "mean_wmae", "median_wmae",
        per_series.agg(F.count("wmae")).scalar().alias("n_series"))


def _absolute_fit(spark, sf):
    p = panel(spark, sf, "region")
    windows = materialize(WN.build_windows(p, 52, 13, 13))
    return p, windows, LN.fit_absolute(windows, 13)


@register("dlinear_absolute_rounds", None, covers="K12")
def q_dlinear_rounds(spark, sf):
    """Weighted mean absolute error and objective before each reweighting round, summed over the 13 steps."""
    fit = _absolute_fit(spark, sf)[2]
    return spark.createDataFrame([(i, a, o) for i, (a, o) in enumerate(fit.rounds)], "round int, weighted_mae double, objective double")


@register("dlinear_absolute_scores", None, covers="K12 D12 D13 D15")
def q_dlinear_absolute(spark, sf):
    """Validation error of the absolute and of the squared loss, in total and as mean and median of the series' own."""
    p, windows, fit = _absolute_fit(spark, sf)
    val = WN.validation_windows(p, 52, 13, 13)
    scored = [LN.score_windows(LN.predict_windows(val, c)).withColumn("loss", F.lit(name))
              for name, c in (("absolute", fit.coefs), ("squared", LN.fit_direct(windows, 13, reg=0.01)))]
    s = materialize(scored[0].unionByName(scored[1]))
    own = mean_and_median(wmae_by(s, ["loss", "store", "dept"]), by=["loss"])
    return s.groupBy("loss").agg(wmae_expr("y", "y_pred").alias("total_wmae")).join(own, "loss")


@register("dlinear_forecast_submission", None, covers="K12 K13 I10 I11 I12 T20 C9 K14")
def q_dlinear_forecast(spark, sf):
    p = panel(spark, sf, "region")
    train, test = TP.train_test_split(p)
    h = TP.TEST_WEEKS
    coefs = LN.fit_direct(WN.build_windows(train, 52, h, 0), h, reg=0.1)
    inf = WN.inference_windows(train, 52).filter(F.col("n_x") == 52)
    fc = LN.predict_windows(inf.withColumn("y", F.array()).withColumn("h", F.array()), coefs)
    steps = fc.select("store", "dept", F.posexplode("forecast").alias("step", "y_model"))
    casc = FB.fallback_cascade(test, train, steps)
    return FB.submission_frame(casc)


# ---- diagnostics ------------------------------------------------------------

_SERIES_SQL = Q.with_(Q.panel_cte("nation"))


@register("dickey_fuller", _SERIES_SQL + """, l AS (SELECT store, dept, weekly_sales AS y,
  lag(weekly_sales) OVER (PARTITION BY store, dept ORDER BY date) AS ylag FROM panel),
g AS (SELECT store, dept, regr_count(y - ylag, ylag) AS n, regr_slope(y - ylag, ylag) AS slope,
  regr_sxx(y - ylag, ylag) AS sxx, regr_sxy(y - ylag, ylag) AS sxy, regr_syy(y - ylag, ylag) AS syy FROM l GROUP BY 1, 2),
t AS (SELECT store, dept, n, slope, slope / sqrt((syy - slope * sxy) / (n - 2) / sxx) AS st FROM g)
SELECT store, dept, CAST(n AS BIGINT) AS n, ROUND(slope, 4) AS slope, ROUND(st, 4) AS df_stat, st < -2.86 AS stationary_5pct FROM t""",
          covers="K16")
def q_dickey_fuller(spark, sf):
    d = DG.dickey_fuller(lazy_panel(spark, sf))
    return r4_cols(d, ["slope", "df_stat"])


def _adf_sql(k: int = 4) -> str:
    """K16 with k lagged differences in SQL: regress dy_t on [1, y_{t-1}, dy_{t-1..t-k}];
    slope, its standard error and the residual sum of squares come from determinants of
    the centred cross-product matrix (Cramer's rule; intercept partialled out)."""
    v = ["dy", "ylag"] + [f"d{j}" for j in range(1, k + 1)]
    lag_cols = ", ".join(f"lag(dy, {j}) OVER (PARTITION BY store, dept ORDER BY date) AS d{j}" for j in range(1, k + 1))
    cond = " AND ".join(f"{x} IS NOT NULL" for x in v)
    sums = ", ".join([f"SUM({a}) AS s_{a}" for a in v] +
                     [f"SUM({a} * {b}) AS s_{a}_{b}" for i, a in enumerate(v) for b in v[i:]])

    def c(a, b):
        a_, b_ = sorted([a, b], key=v.index)
        return f"(s_{a_}_{b_} - s_{a} * s_{b} / n)"
    x = v[1:]
    cxx = [[c(a, b) for b in x] for a in x]
    cxy = [c(a, "dy") for a in x]
    num = [[cxy[i] if j == 0 else cxx[i][j] for j in range(len(x))] for i in range(len(x))]
    minor = [row[1:] for row in cxx[1:]]
    full = [[c(a, b) for b in v] for a in v]
    kk = len(v)  # regressors incl. intercept = 1 + (len(v) - 1)
    return _SERIES_SQL + f""", y AS (SELECT store, dept, date, weekly_sales AS y FROM panel),
b AS (SELECT store, dept, date, y - lag(y) OVER (PARTITION BY store, dept ORDER BY date) AS dy,
      lag(y) OVER (PARTITION BY store, dept ORDER BY date) AS ylag FROM y),
l AS (SELECT *, {lag_cols} FROM b),
m AS (SELECT store, dept, COUNT(*) AS n, {sums} FROM l WHERE {cond} GROUP BY 1, 2),
r AS (SELECT store, dept, n, {Q.det_sql(cxx)} AS dxx, {Q.det_sql(num)} AS dnum, {Q.det_sql(minor)} AS dmin,
      {Q.det_sql(full)} AS dfull FROM m),
t AS (SELECT store, dept, n, (dnum / dxx) / sqrt((dfull / dxx) / (n - {kk}) * (dmin / dxx)) AS st FROM r),
cnt AS (SELECT store, dept, COUNT(*) AS n_all FROM panel GROUP BY 1, 2)
SELECT t.store, t.dept, {k} AS lags, CAST(cnt.n_all AS INTEGER) AS n, ROUND(t.st, 4) AS adf_stat,
  CAST(NULL AS VARCHAR) AS error, t.st < -2.86 AS stationary_5pct
FROM t JOIN cnt ON t.store = cnt.store AND t.dept = cnt.dept"""


@register("adf_k_lags", _adf_sql(4), covers="K16 K25")
def q_adf(spark, sf):
    return r4_cols(DG.adf_test(lazy_panel(spark, sf), lags=4), ["adf_stat"])


def _adf_auto_sql(max_lag: int = 12) -> str:
    """K16 with the order chosen: the cross-products of [1, ylag, dy lags, dy] swept pivot by pivot in a recursive CTE."""
    v = ["1.0", "ylag", *[f"d{k}" for k in range(1, max_lag + 1)], "d0"]
    size = len(v)
    rows = ", ".join("[" + ", ".join(f"SUM(CAST({a} AS DOUBLE) * {b})" for b in v) + "]" for a in v)
    lags = ", ".join(f"lag(d0, {k}) OVER (PARTITION BY store, dept ORDER BY date) AS d{k}" for k in range(1, max_lag + 1))
    p = "m[k + 1][k + 1]"
    return "WITH RECURSIVE " + _SERIES_SQL[_SERIES_SQL.index("WITH ") + 5:] + f""", b AS (SELECT store, dept, date,
  weekly_sales - lag(weekly_sales) OVER (PARTITION BY store, dept ORDER BY date) AS d0,
  lag(weekly_sales) OVER (PARTITION BY store, dept ORDER BY date) AS ylag FROM panel),
l AS (SELECT *, {lags} FROM b),
s0 AS (SELECT store, dept, COUNT(*) AS n, [{rows}] AS m FROM l WHERE d{max_lag} IS NOT NULL GROUP BY 1, 2),
sw AS (SELECT store, dept, n, 0 AS k, m FROM s0 WHERE n > {max_lag + 3}
  UNION ALL
  SELECT store, dept, n, k + 1, [[CASE WHEN i = k + 1 AND j = k + 1 THEN -1 / {p} WHEN i = k + 1 OR j = k + 1 THEN m[i][j] / {p}
    ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / {p} END FOR j IN range(1, {size + 1})] FOR i IN range(1, {size + 1})]
  FROM sw WHERE k < {size - 1}),
o AS (SELECT store, dept, n, k - 2 AS lags, n * ln(m[{size}][{size}] / n) + 2 * k AS aic,
  m[2][{size}] / sqrt(m[{size}][{size}] / (n - k) * -m[2][2]) AS st FROM sw WHERE k >= 2),
c AS (SELECT store, dept, n, arg_min(lags, (aic, lags)) AS lags, arg_min(st, (aic, lags)) AS st FROM o GROUP BY 1, 2, 3),
z AS (SELECT *, CASE WHEN st <= -1.61 THEN 2.1659 + st * 1.4412 + st * st * 0.038269
  ELSE 1.7339 + st * 0.93202 - st * st * 0.12745 - st * st * st * 0.010368 END AS z FROM c),
t AS (SELECT *, 1 / (1 + 0.2316419 * abs(z)) AS t FROM z),
q AS (SELECT *, exp(-z * z / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))) AS tail FROM t),
pv AS (SELECT *, CASE WHEN st < -18.83 THEN 0.0 WHEN st > 2.74 THEN 1.0 WHEN z >= 0 THEN 1 - tail ELSE tail END AS p FROM q),
al AS (SELECT store, dept, COUNT(*) FILTER (d{max_lag} IS NOT NULL) AS n FROM l GROUP BY 1, 2)
SELECT al.store, al.dept, al.n, CAST(pv.lags AS INTEGER) AS lags, ROUND(pv.st, 4) AS adf_stat,
  CASE WHEN pv.n IS NULL THEN 'series too short' END AS error, ROUND(pv.p, 4) AS p_value, pv.p < 0.05 AS stationary_5pct
FROM al LEFT JOIN pv ON al.store = pv.store AND al.dept = pv.dept"""


@register("adf_auto", _adf_auto_sql(), covers="K16 K25")
def q_adf_auto(spark, sf):
    """Dickey-Fuller with the lag order by AIC (0 to 12) and MacKinnon's p-value; short series stay, with an error."""
    return r4_cols(DG.adf_auto(lazy_panel(spark, sf), 12), ["adf_stat", "p_value"])


def _acf_sql(max_lag: int = 40) -> str:
    lags = ", ".join(f"lag(z, {k}) OVER (PARTITION BY store, dept ORDER BY date) AS l{k}" for k in range(1, max_lag + 1))
    sums = ", ".join(f"SUM(z * l{k}) AS s{k}" for k in range(1, max_lag + 1))
    unions = " UNION ALL ".join(f"SELECT store, dept, {k} AS lag, s{k} / s0 AS acf FROM s"
                                for k in range(1, max_lag + 1))
    return _SERIES_SQL + f""", c AS (SELECT store, dept, date,
  weekly_sales - AVG(weekly_sales) OVER (PARTITION BY store, dept) AS z FROM panel),
l AS (SELECT store, dept, z, {lags} FROM c),
s AS (SELECT store, dept, SUM(z * z) AS s0, {sums} FROM l GROUP BY 1, 2),
a AS (SELECT store, dept, 0 AS lag, s0 / s0 AS acf FROM s UNION ALL {unions})
SELECT store, dept, CAST(lag AS INTEGER) AS lag, ROUND(acf, 4) AS acf FROM a"""


@register("acf", _acf_sql(), covers="K17")
def q_acf(spark, sf):
    return r4_cols(DG.autocorrelation(lazy_panel(spark, sf), 40), ["acf"])


def _pacf_sql(max_lag: int = 40) -> str:
    acf = _acf_sql(max_lag)
    body = acf[acf.index("WITH ") + 5:acf.rindex("SELECT store, dept, CAST(lag AS INTEGER)")]
    return "WITH RECURSIVE " + body + f""", rl AS (SELECT store, dept, list(acf ORDER BY lag) AS r FROM a GROUP BY 1, 2),
dl AS (
  SELECT store, dept, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS v, CAST(1.0 AS DOUBLE) AS pk, r
  FROM rl
  UNION ALL
  SELECT store, dept, k + 1, list_concat([phi[j] - an * phi[k + 1 - j] FOR j IN range(1, k + 1)], [an]),
         v * (1 - an * an), an, r
  FROM (SELECT *, (r[k + 2] - COALESCE(list_sum([phi[j] * r[k + 2 - j] FOR j IN range(1, k + 1)]), 0)) / v AS an
        FROM dl WHERE k < {max_lag} AND v > 0)
)
SELECT store, dept, CAST(k AS INTEGER) AS lag, ROUND(pk, 4) AS pacf FROM dl"""


@register("pacf", _pacf_sql(), covers="K18")
def q_pacf(spark, sf):
    return r4_cols(DG.partial_autocorrelation(DG.autocorrelation(lazy_panel(spark, sf), 40)), ["pacf"])


@register("seasonal_decompose", _SERIES_SQL + """, c AS (SELECT *, CAST(ROUND(weekly_sales * 100) AS BIGINT) AS cents
  FROM panel),
t AS (SELECT store, dept, date, cents,
  row_number() OVER (PARTITION BY store, dept ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY store, dept) AS n,
  (SUM(cents) OVER (PARTITION BY store, dept ORDER BY date ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING)
   + 0.5 * (lag(cents, 26) OVER (PARTITION BY store, dept ORDER BY date)
            + lead(cents, 26) OVER (PARTITION BY store, dept ORDER BY date))) / 52 AS trend FROM c),
t2 AS (SELECT *, (rn - 1) % 52 AS pos, cents - trend AS detr FROM t WHERE n >= 104),
i AS (SELECT store, dept, pos, AVG(detr) AS s FROM t2 GROUP BY 1, 2, 3),
i2 AS (SELECT store, dept, pos, s - AVG(s) OVER (PARTITION BY store, dept) AS seasonal FROM i)
SELECT t2.store, t2.dept, t2.date, ROUND(t2.trend / 100.0, 4) AS trend, ROUND(i2.seasonal / 100.0, 4) AS seasonal,
  ROUND((t2.cents - t2.trend - i2.seasonal) / 100.0, 4) AS resid
FROM t2 LEFT JOIN i2 ON t2.store = i2.store AND t2.dept = i2.dept AND t2.pos = i2.pos""", covers="E10")
def q_seasonal_decompose(spark, sf):
    p = lazy_panel(spark, sf).withColumn("cents", F.round(F.col("weekly_sales") * 100).cast("bigint"))
    d = DG.seasonal_decompose(p, 52, target="cents")
    return d.select("store", "dept", "date", r4(F.col("trend") / 100.0, "trend"),
                    r4(F.col("seasonal") / 100.0, "seasonal"), r4(F.col("resid") / 100.0, "resid"))


# ---- per-series classical models -------------------------------------------

def _series_frame(spark, sf):
    p = panel(spark, sf)
    return p, AR.fold_frame(p, n_splits=3, horizon_weeks=13, min_train=30)


def _score_by_series(pred: DataFrame, model: str) -> DataFrame:
    # one pass over the predictions; a series whose folds all failed stays, with a NULL score and no scored fold
    ok = F.col("error").isNull() & F.col("y_pred").isNotNull()
    part = F.when(ok, holiday_weight("is_holiday")).alias("w")
    per_fold = (pred.select("store", "dept", "fold", part, F.abs(F.col("y") - F.col("y_pred")).alias("e"))
                .groupBy("store", "dept", "fold").agg((F.sum(F.col("w") * F.col("e")) / F.sum("w")).alias("wmae")))
    return per_fold.groupBy("store", "dept").agg(F.avg("wmae").alias("wmae"), F.count("wmae").alias("n_folds")).withColumn("model", F.lit(model))


def _ar_order_sql(max_p: int = 3) -> str:
    """K19 in SQL: for regression with an intercept the residual sum of squares is
    det(centred cross-products of [z_t, lags]) / det(centred cross-products of lags)."""
    lags = ", ".join(f"lag(z, {k}) OVER (PARTITION BY store, dept, d ORDER BY date) AS v{k}"
                     for k in range(1, max_p + 1))
    blocks = []
    for p in range(max_p + 1):
        v = [f"v{k}" for k in range(p + 1)]
        cond = " AND ".join(f"v{k} IS NOT NULL" for k in range(max_p + 1))  # one sample for all orders
        sums = ", ".join([f"SUM({a}) AS s_{a}" for a in v] +
                         [f"SUM({a} * {b}) AS s_{a}_{b}" for i, a in enumerate(v) for b in v[i:]])
        blocks.append(f"SELECT store, dept, d, {p} AS p, COUNT(*) AS n, {sums} FROM l WHERE {cond} GROUP BY 1, 2, 3")
    out = []
    for p in range(max_p + 1):
        v = [f"v{k}" for k in range(p + 1)]

        def c(a, b):
            a_, b_ = sorted([a, b], key=v.index)
            return f"(s_{a_}_{b_} - s_{a} * s_{b} / n)"
        full = [[c(a, b) for b in v] for a in v]
        xx = [[c(a, b) for b in v[1:]] for a in v[1:]]
        ssr = Q.det_sql(full) if p == 0 else f"{Q.det_sql(full)} / {Q.det_sql(xx)}"
        out.append(f"SELECT store, dept, d, p, n, n * ln(({ssr}) / n) + 2 * (p + 1) AS aic FROM ({blocks[p]})")
    grid = " UNION ALL ".join(out)
    return _SERIES_SQL + f""", y AS (SELECT store, dept, date, weekly_sales AS y FROM panel),
zz AS (SELECT store, dept, date, 0 AS d, y AS z FROM y
       UNION ALL
       SELECT * FROM (SELECT store, dept, date, 1 AS d,
              y - lag(y) OVER (PARTITION BY store, dept ORDER BY date) AS z FROM y) WHERE z IS NOT NULL),
l AS (SELECT store, dept, d, date, z AS v0, {lags} FROM zz),
grid AS ({grid}),
dl AS (SELECT store, dept, y - lag(y) OVER (PARTITION BY store, dept ORDER BY date) AS dy,
       lag(y) OVER (PARTITION BY store, dept ORDER BY date) AS ylag FROM y),
df AS (SELECT store, dept, regr_slope(dy, ylag) AS b, regr_sxx(dy, ylag) AS sxx, regr_sxy(dy, ylag) AS sxy,
       regr_syy(dy, ylag) AS syy, regr_count(dy, ylag) AS n FROM dl GROUP BY 1, 2),
dsel AS (SELECT store, dept, CASE WHEN b / sqrt((syy - b * sxy) / (n - 2) / sxx) < -2.86 THEN 0 ELSE 1 END AS dd
         FROM df)
SELECT s.store, s.dept, CAST(arg_min(g.p, (g.aic, g.p)) AS INTEGER) AS p, CAST(MIN(g.d) AS INTEGER) AS d,
  ROUND(MIN(g.aic), 4) AS aic, CASE WHEN COUNT(g.aic) = 0 THEN 'too few observations for AR order' END AS error
FROM dsel s LEFT JOIN grid g ON g.store = s.store AND g.dept = s.dept AND g.d = s.dd AND g.n > g.p + 2 AND g.aic IS NOT NULL GROUP BY 1, 2"""


@register("ar_order_selection", _ar_order_sql(), covers="K19 K16")
def q_ar_order(spark, sf):
    p = lazy_panel(spark, sf)
    o = AR.choose_order(AR.order_grid(p, 3), DG.dickey_fuller(p))
    return o.select("store", "dept", F.col("p").cast("int").alias("p"), F.col("d").cast("int").alias("d"), r4("aic"), "error")


def _ar_fold_ctes(seasonal: bool, pre: str, horizon_weeks: int = 13, n_splits: int = 3,
                  min_train: int = 30) -> str:
    """CTEs ``{pre}fr`` (fold rows) ... ``{pre}pf`` (WMAE per series and fold) for the AR(1)
    walk-forward on first (and, if ``seasonal``, 52-week seasonal) differences.

    The AR(1) fit is a simple regression; the forecast recursion is a recursive CTE;
    re-integration telescopes to ``(s1_T + S_k) + y_{T+k-52}`` (seasonal) or
    ``y_T + S_k`` with S_k the running sum of forecast differences, in the same
    operation order as the grouped numpy function.
    """
    days = 7 * horizon_weeks
    w = "PARTITION BY store, dept, fold ORDER BY date"
    W = "(CASE WHEN is_holiday IS NULL OR is_holiday THEN 5 ELSE 1 END)"
    if seasonal:
        z = f"(y - lag(y, 52) OVER ({w})) - (lag(y, 1) OVER ({w}) - lag(y, 53) OVER ({w}))"
        level = f"y - lag(y, 52) OVER ({w})"
        hist = (f"JOIN {pre}tr h ON h.store = v.store AND h.dept = v.dept AND h.fold = v.fold "
                f"AND h.date = v.date - 364")
        pred = "(l.s1_t + r.sk) + h.y"
    else:
        z = f"y - lag(y, 1) OVER ({w})"
        level = "y"
        hist = ""
        pred = "l.s1_t + r.sk"
    return f"""{pre}b AS (SELECT store, dept, MIN(date) AS lo, MAX(date) AS hi FROM panel GROUP BY 1, 2),
{pre}grid AS (SELECT b.store, b.dept, CAST(g.d AS DATE) AS date
         FROM {pre}b b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 7 DAY) g(d)),
{pre}d0 AS (SELECT g.store, g.dept, g.date, p.weekly_sales, p.is_holiday
       FROM {pre}grid g LEFT JOIN panel p ON g.store = p.store AND g.dept = p.dept AND g.date = p.date),
{pre}dense AS (SELECT store, dept, date, last_value(weekly_sales IGNORE NULLS) OVER (PARTITION BY store, dept
            ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y,
          weekly_sales IS NULL AS is_filled, COALESCE(is_holiday, FALSE) AS is_holiday FROM {pre}d0),
{pre}f0 AS (SELECT store, dept, CAST(t.i AS INTEGER) AS i, hi - CAST(t.i AS INTEGER) * {days} AS val_end,
       hi - (CAST(t.i AS INTEGER) + 1) * {days} AS val_start, lo FROM {pre}b, range(0, {n_splits}) t(i)),
{pre}f1 AS (SELECT * FROM {pre}f0 WHERE val_start > lo),
{pre}folds AS (SELECT store, dept, CAST(COUNT(*) OVER (PARTITION BY store, dept) - 1 - i AS INTEGER) AS fold,
          val_start, val_end FROM {pre}f1),
{pre}j AS (SELECT d.*, f.fold, f.val_start, CASE WHEN d.date < f.val_start THEN 'train' ELSE 'val' END AS role
      FROM {pre}dense d JOIN {pre}folds f ON d.store = f.store AND d.dept = f.dept AND d.date <= f.val_end),
{pre}j2 AS (SELECT * FROM {pre}j WHERE role = 'train' OR NOT is_filled),
{pre}g AS (SELECT *, COUNT(*) FILTER (WHERE role = 'train' AND NOT is_filled) OVER (PARTITION BY store, dept, fold)
        AS ntr, COUNT(*) FILTER (WHERE role = 'val') OVER (PARTITION BY store, dept, fold) AS nva FROM {pre}j2),
{pre}fr AS (SELECT * FROM {pre}g WHERE ntr >= {min_train} AND nva > 0),
{pre}tr AS (SELECT store, dept, fold, date, y FROM {pre}fr WHERE role = 'train'),
{pre}zt AS (SELECT *, {level} AS s1, {z} AS z FROM {pre}tr),
{pre}zl AS (SELECT *, lag(z) OVER ({w}) AS zl FROM {pre}zt),
{pre}fit AS (SELECT store, dept, fold, regr_slope(z, zl) AS phi, regr_intercept(z, zl) AS c FROM {pre}zl
        WHERE z IS NOT NULL AND zl IS NOT NULL GROUP BY 1, 2, 3),
{pre}lst AS (SELECT store, dept, fold, MAX(date) AS t_date, arg_max(z, date) AS z_t, arg_max(s1, date) AS s1_t
        FROM {pre}zt GROUP BY 1, 2, 3),
{pre}rec AS (
  SELECT l.store, l.dept, l.fold, 0 AS k, l.z_t AS zk, CAST(0.0 AS DOUBLE) AS sk, f.phi, f.c
  FROM {pre}lst l JOIN {pre}fit f ON l.store = f.store AND l.dept = f.dept AND l.fold = f.fold
  UNION ALL
  SELECT store, dept, fold, k + 1, c + phi * zk, sk + (c + phi * zk), phi, c FROM {pre}rec
  WHERE k < {horizon_weeks + 2}
),
{pre}pred AS (SELECT v.store, v.dept, v.fold, v.y, v.is_holiday, {pred} AS y_pred
         FROM {pre}fr v JOIN {pre}lst l ON v.store = l.store AND v.dept = l.dept AND v.fold = l.fold
         JOIN {pre}rec r ON r.store = v.store AND r.dept = v.dept AND r.fold = v.fold
              AND r.k = CAST((v.date - l.t_date) / 7 AS INTEGER)
         {hist}
         WHERE v.role = 'val'),
{pre}pf AS (SELECT store, dept, fold, SUM({W} * abs(y - y_pred)) / SUM({W}) AS wmae FROM {pre}pred GROUP BY 1, 2, 3),
{pre}ps AS (SELECT store, dept, AVG(wmae) AS wmae, COUNT(*) AS n_folds FROM {pre}pf GROUP BY 1, 2)"""


def _recursive_series() -> str:
    return "WITH RECURSIVE " + _SERIES_SQL[len("WITH "):]


def _sarima_sql() -> str:
    return _recursive_series() + ", " + _ar_fold_ctes(True, "s_") + """
SELECT store, dept, ROUND(wmae, 4) AS wmae, n_folds, 'sar_1_1_1_52' AS model FROM s_ps"""


def _arima_vs_sarima_sql() -> str:
    return _recursive_series() + ", " + _ar_fold_ctes(False, "a_") + ", " + _ar_fold_ctes(True, "s_") + """
SELECT COALESCE(a.store, s.store) AS store, COALESCE(a.dept, s.dept) AS dept, ROUND(a.wmae, 4) AS ar_1_1,
  ROUND(s.wmae, 4) AS sar_1_1_1_52,
  ROUND(CASE WHEN a.wmae <> 0 THEN (a.wmae - s.wmae) / a.wmae END * 100, 4) AS improvement_pct
FROM a_ps a FULL OUTER JOIN s_ps s ON a.store = s.store AND a.dept = s.dept"""


@register("sarima_walk_forward", _sarima_sql(), covers="K20 K25 E8 I4 J1 B14 D14 L7")
def q_sarima(spark, sf):
    return r4_cols(_score_by_series(AR.evaluate_ar1_folds(*_dense_and_folds(spark, sf)), "sar_1_1_1_52"), ["wmae"])


def _ols_sql(y: str, xs: list[str]) -> tuple[str, list[str], str]:
    """(sums, slopes, intercept) of the regression of ``y`` on ``xs`` and a constant, by determinants of centred sums."""
    v = [y, *xs]
    sums = ", ".join([f"SUM({a}) AS s_{a}" for a in v] + [f"SUM({a} * {b}) AS s_{a}_{b}" for i, a in enumerate(v) for b in v[i:]])

    def c(a, b):
        a_, b_ = sorted([a, b], key=v.index)
        return f"(s_{a_}_{b_} - s_{a_} * s_{b_} / n)"
    xx = Q.det_sql([[c(a, b) for b in xs] for a in xs])
    slopes = [f"({Q.det_sql([[c(a, y) if k == j else c(a, b) for k, b in enumerate(xs)] for a in xs])}) / ({xx})" for j in range(len(xs))]
    return sums, slopes, "(s_" + y + " - " + " - ".join(f"b{j} * s_{x}" for j, x in enumerate(xs)) + ") / n"


def _arma_ctes(long_ar: int = 4, min_rows: int = 30) -> str:
    """Two-stage regression with the innovations written out row by row: CTEs up to ``fit``."""
    lags = [*range(1, long_ar + 2), *range(52, 53 + long_ar)]
    w = "OVER (PARTITION BY store, dept ORDER BY date)"
    sums1, slopes1, c1 = _ols_sql("z0", [f"z{k}" for k in range(1, long_ar + 1)])
    sums2, slopes2, c2 = _ols_sql("z0", ["z1", "e1", "e52"])
    e = lambda lag: f"z{lag} - c - " + " - ".join(f"b{k - 1} * z{lag + k}" for k in range(1, long_ar + 1))
    return _recursive_series() + ", " + _ar_fold_ctes(True, "s_") + f""",
lv AS (SELECT *, y - lag(y, 52) {w} AS level FROM s_dense),
z0 AS (SELECT *, level - lag(level) {w} AS z0 FROM lv),
z AS (SELECT *, {", ".join(f"lag(z0, {k}) {w} AS z{k}" for k in lags)} FROM z0),
j AS (SELECT z.*, f.fold, f.val_start, f.val_end FROM z JOIN s_folds f ON z.store = f.store AND z.dept = f.dept),
tr AS (SELECT * FROM j WHERE date < val_start AND z{lags[-1]} IS NOT NULL),
seen AS (SELECT store, dept, fold, COUNT(*) FILTER (z{lags[-1]} IS NOT NULL) AS n FROM j WHERE date < val_start GROUP BY 1, 2, 3),
m1 AS (SELECT store, dept, fold, COUNT(*) AS n, {sums1} FROM tr GROUP BY 1, 2, 3 HAVING COUNT(*) >= {min_rows}),
b1 AS (SELECT *, {c1} AS c FROM (SELECT *, {", ".join(f"{s} AS b{k}" for k, s in enumerate(slopes1))} FROM m1)),
l1 AS (SELECT store, dept, fold, c, {", ".join(f"b{k}" for k in range(long_ar))} FROM b1),
tr2 AS (SELECT tr.store, tr.dept, tr.fold, z0, z1, {e(1)} AS e1, {e(52)} AS e52
  FROM tr JOIN l1 ON tr.store = l1.store AND tr.dept = l1.dept AND tr.fold = l1.fold),
m2 AS (SELECT store, dept, fold, COUNT(*) AS n, {sums2} FROM tr2 GROUP BY 1, 2, 3),
fit AS (SELECT *, {c2} AS icpt FROM (SELECT *, {", ".join(f"{s} AS b{k}" for k, s in enumerate(slopes2))} FROM m2))"""


_FEW = "'too few observations for the two-stage fit'"


def _arma_coefficients_sql() -> str:
    return _arma_ctes() + f"""
SELECT s.store, s.dept, s.fold, s.n, ROUND(f.b0, 4) AS phi, ROUND(f.b1, 4) AS theta, ROUND(f.b2, 4) AS seasonal_theta,
  CASE WHEN f.n IS NULL THEN {_FEW} END AS error
FROM seen s LEFT JOIN fit f ON s.store = f.store AND s.dept = f.dept AND s.fold = f.fold"""


def _arma_forecast_sql() -> str:
    e0 = "z0 - c - b0 * z1 - b1 * z2 - b2 * z3 - b3 * z4"
    keys = lambda a, b: f"{a}.store = {b}.store AND {a}.dept = {b}.dept AND {a}.fold = {b}.fold"
    w = "(CASE WHEN is_holiday IS NULL OR is_holiday THEN 5 ELSE 1 END)"
    return _arma_ctes() + f""",
ev AS (SELECT j.store, j.dept, j.fold, j.date, j.y, COALESCE({e0}, 0) AS e FROM j JOIN l1 ON {keys("j", "l1")} WHERE j.date < j.val_start),
lt AS (SELECT store, dept, fold, MAX(date) AS t, arg_max(z0, date) AS zt, arg_max(level, date) AS lt FROM j WHERE date < val_start GROUP BY 1, 2, 3),
fc AS (
  SELECT f.store, f.dept, f.fold, 0 AS k, lt.t, lt.zt AS zk, CAST(0.0 AS DOUBLE) AS sk, icpt, b0, b1, b2 FROM fit f JOIN lt ON {keys("f", "lt")}
  UNION ALL
  SELECT store, dept, fold, k, t, nz, sk + nz, icpt, b0, b1, b2 FROM (
    SELECT r.store, r.dept, r.fold, r.k + 1 AS k, r.t, r.sk, icpt, b0, b1, b2,
      icpt + b0 * r.zk + b1 * CASE WHEN r.k = 0 THEN COALESCE(p.e, 0) ELSE 0.0 END + b2 * COALESCE(q.e, 0) AS nz
    FROM fc r LEFT JOIN ev p ON {keys("p", "r")} AND p.date = r.t LEFT JOIN ev q ON {keys("q", "r")} AND q.date = r.t + 7 * (r.k + 1 - 52)
    WHERE r.k < 15)),
pr AS (SELECT j.store, j.dept, j.fold, j.y, j.is_holiday, lt.lt + fc.sk + h.y AS y_pred
  FROM j JOIN lt ON {keys("j", "lt")} JOIN fc ON {keys("j", "fc")} AND fc.k = CAST((j.date - lt.t) / 7 AS INTEGER)
  JOIN ev h ON {keys("j", "h")} AND h.date = j.date - 364
  WHERE j.date >= j.val_start AND j.date <= j.val_end AND NOT j.is_filled),
pf AS (SELECT store, dept, fold, SUM({w} * abs(y - y_pred)) / SUM({w}) AS wmae FROM pr GROUP BY 1, 2, 3),
al AS (SELECT DISTINCT store, dept, fold FROM j WHERE date >= val_start AND date <= val_end AND NOT is_filled)
SELECT al.store, al.dept, ROUND(AVG(wmae) / 1e4, 4) AS wmae_10k, COUNT(wmae) AS n_folds, 'sarima_1_1_1_52' AS model
FROM al LEFT JOIN pf ON {keys("al", "pf")} GROUP BY 1, 2"""


def _dense_and_folds(spark, sf):
    base = panel(spark, sf).select("store", "dept", "date", "weekly_sales", "is_holiday")
    return densify_ffill(base), SP.series_fold_bounds(base, n_splits=3, horizon_weeks=13)


@register("arma_coefficients", _arma_coefficients_sql(), covers="K20 K25")
def q_arma_coefficients(spark, sf):
    """(1, 1, 1)(0, 1, 1, 52) per series and fold; a fold with too few rows keeps its row."""
    f = AR.arma_fits(*_dense_and_folds(spark, sf))
    return r4_cols(f.select("store", "dept", "fold", "n", "phi", "theta", "seasonal_theta", "error"), ["phi", "theta", "seasonal_theta"])


@register("sarima_ma_walk_forward", _arma_forecast_sql(), covers="K20 K25 E8 J1 D14")
def q_sarima_ma(spark, sf):
    """Walk-forward WMAE (in units of 10,000) of the model with moving-average terms; a series without a fitted fold stays."""
    s = _score_by_series(AR.evaluate_arma(*_dense_and_folds(spark, sf)), "sarima_1_1_1_52")
    return s.select("store", "dept", r4(F.col("wmae") / 1e4, "wmae_10k"), "n_folds", "model")


def _fold_failures_sql() -> str:
    return ("WITH RECURSIVE " + Q.with_(Q.panel_cte("brand"))[len("WITH "):] + ", " + _ar_fold_ctes(True, "s_") + """,
pairs AS (SELECT store, dept, fold, COUNT(zl) AS n FROM s_zl GROUP BY 1, 2, 3)
SELECT (SELECT COUNT(*) FROM s_folds) AS n_folds, (SELECT COUNT(*) FROM s_folds) - COUNT(*) AS n_guarded,
  COUNT(*) FILTER (WHERE n <= 3) AS n_failed, COUNT(*) FILTER (WHERE n > 3) AS n_fitted FROM pairs""")


@register("ar_fold_failures", _fold_failures_sql(), covers="K20 K25 B14")
def q_ar_fold_failures(spark, sf):
    """Brand grain, short series included: folds left out by the guard, failed and fitted."""
    p = panel(spark, sf, "brand")
    frame = AR.fold_frame(p, n_splits=3, horizon_weeks=13, min_train=30)
    n_folds = SP.series_fold_bounds(p, n_splits=3, horizon_weeks=13).agg(F.count(F.lit(1))).scalar()
    folds = AR.evaluate_ar1(frame).groupBy("store", "dept", "fold").agg(F.max("error").alias("error"))
    one = folds.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("n_failed"))
    return one.select(n_folds.alias("n_folds"), (n_folds - F.col("n")).alias("n_guarded"), "n_failed", (F.col("n") - F.col("n_failed")).alias("n_fitted"))


@register("arima_vs_sarima", _arima_vs_sarima_sql(), covers="K20 D24 F6")
def q_arima_vs_sarima(spark, sf):
    dense, folds = _dense_and_folds(spark, sf)
    a = _score_by_series(AR.evaluate_ar1_folds(dense, folds, seasonal=False), "ar_1_1")
    s = _score_by_series(AR.evaluate_ar1_folds(dense, folds, seasonal=True), "sar_1_1_1_52")
    c = compare_models(a.unionByName(s), ["store", "dept"], "model", "wmae", "ar_1_1", "sar_1_1_1_52")
    return r4_cols(c, ["ar_1_1", "sar_1_1_1_52", "improvement_pct"])


def _calendar(spark):
    return holiday_frame(spark, PANEL_HOLIDAYS)


@register("additive_walk_forward", None, covers="K21 H17 K25")
def q_additive(spark, sf):
    _, frame = _series_frame(spark, sf)
    return _score_by_series(AD.evaluate_additive(frame, _calendar(spark)), "additive_holidays")


@register("additive_holiday_ablation", None, covers="J6 D24 K21")
def q_additive_ablation(spark, sf):
    _, frame = _series_frame(spark, sf)
    a = _score_by_series(AD.evaluate_additive(frame, None), "no_holidays")
    b = _score_by_series(AD.evaluate_additive(frame, _calendar(spark)), "holidays")
    return compare_models(a.unionByName(b), ["store", "dept"], "model", "wmae", "no_holidays", "holidays")


@register("multiplicative_walk_forward", None, covers="K22")
def q_multiplicative(spark, sf):
    _, frame = _series_frame(spark, sf)
    return _score_by_series(AD.evaluate_additive(frame, _calendar(spark), multiplicative=True), "multiplicative")


@register("sparse_trend_walk_forward", None, covers="K21 K25 D14")
def q_sparse_trend(spark, sf):
    """Walk-forward WMAE of the model with sparse trend changes."""
    _, frame = _series_frame(spark, sf)
    return _score_by_series(CH.evaluate_sparse(frame, _calendar(spark)), "sparse_trend")


@register("trend_changes", None, covers="K21")
def q_trend_changes(spark, sf):
    """The changes of slope that stay, per series and fold."""
    _, frame = _series_frame(spark, sf)
    design, free, hinges = CH.trend_design(frame, _calendar(spark))
    return CH.change_points(CH.sparse_trend(CH.trend_products(design, [*free, *hinges]), len(free), len(hinges)), len(free), len(hinges))


_PRODUCT_KNOTS = 4


def _trend_products_sql() -> str:
    names = ["one", "u", "sin1", "cos1", *[f"hinge{i}" for i in range(1, _PRODUCT_KNOTS + 1)], "y"]
    hinges = ", ".join(f"greatest(0.0, u - {CH.place(i, _PRODUCT_KNOTS)!r}) AS hinge{i}" for i in range(1, _PRODUCT_KNOTS + 1))
    angle = f"dd * {2 * math.pi / AD.YEAR_DAYS!r}"
    pairs = " UNION ALL ".join(f"SELECT store, dept, fold, '{a}' AS a, '{b}' AS b, SUM({a} * {b}) AS v FROM x GROUP BY 1, 2, 3"
                               for i, a in enumerate(names) for b in names[i:])
    return _recursive_series() + ", " + _ar_fold_ctes(True, "s_") + f""",
d AS (SELECT store, dept, fold, role, y / 9973.0 AS y, CAST(date - DATE '1970-01-01' AS DOUBLE) AS dd FROM s_fr),
w AS (SELECT *, MIN(CASE WHEN role = 'train' THEN dd END) OVER q AS lo, MAX(CASE WHEN role = 'train' THEN dd END) OVER q AS hi FROM d
  WINDOW q AS (PARTITION BY store, dept, fold)),
un AS (SELECT *, (dd - lo) / greatest(hi - lo, 1.0) AS u FROM w WHERE role = 'train'),
x AS (SELECT store, dept, fold, 1.0 AS one, u, sin({angle}) AS sin1, cos({angle}) AS cos1, {hinges}, y FROM un)
SELECT store, dept, fold, a, b, ROUND(v / 9.973, 4) AS v FROM ({pairs})"""


@register("trend_cross_products", _trend_products_sql(), covers="K21")
def q_trend_products(spark, sf):
    """The sums that the sparse trend is solved from, for one yearly wave and four hinges; odd units (9,973 for y, 9.973 for sums), so that no sum is a rounding tie."""
    _, frame = _series_frame(spark, sf)
    design, free, hinges = CH.trend_design(frame.withColumn("y", F.col("y") / 9973.0), None, 1, _PRODUCT_KNOTS)
    names = [*free, *hinges]
    g = CH.trend_products(design, names)
    labels = F.array(*[F.lit(n) for n in [*names, "y"]])
    rows = g.select("store", "dept", "fold", F.posexplode("g").alias("i", "row")).select("store", "dept", "fold", "i", F.posexplode("row").alias("j", "v"))
    return rows.filter("i <= j").select("store", "dept", "fold", labels[F.col("i")].alias("a"), labels[F.col("j")].alias("b"), r4(F.col("v") / 9.973, "v"))


@register("future_dates", _SERIES_SQL + """, l AS (SELECT store, dept, MAX(date) AS last_d FROM panel GROUP BY 1, 2)
SELECT store, dept, date, FALSE AS is_future FROM panel
UNION ALL
SELECT store, dept, CAST(last_d + CAST(7 * k AS INTEGER) AS DATE) AS date, TRUE AS is_future FROM l, range(1, 14) r(k)""",
          covers="K23 I1")
def q_future_dates(spark, sf):
    return AD.future_dates(panel(spark, sf), 13)


# Fixed query parameter: the representative (store, dept) pairs examined
# one by one in the per-series notebooks are a sampling feature.
SAMPLE_PAIRS = [(0, 1), (1, 3), (2, 6), (3, 2), (4, 5)]


@register("representative_series", _SERIES_SQL + "SELECT * FROM panel WHERE (store, dept) IN (" +
          ", ".join(f"({s}, {d})" for s, d in SAMPLE_PAIRS) + ")", covers="K24 B6 C12")
def q_representative(spark, sf):
    pairs = spark.createDataFrame(SAMPLE_PAIRS, "store int, dept int")
    return lazy_panel(spark, sf).join(F.broadcast(pairs), ["store", "dept"], "left_semi")


def write_reference_layout(spark: SparkSession, sf: str, path: str) -> None:
    """Write the derived panel in the reference's CSV layout (train/test/features/stores)."""
    p = panel(spark, sf)
    train, test = TP.train_test_split(p, unseen=None)
    ren = {v: k for k, v in RENAME.items()}
    def out(df, name):
        df.select([F.col(c).alias(ren.get(c, c)) for c in df.columns]).write.mode("overwrite") \
          .option("header", True).option("dateFormat", "yyyy-MM-dd").csv(os.path.join(path, name + ".csv"))
    out(train.select("store", "dept", "date", "weekly_sales", "is_holiday"), "train")
    out(test.select("store", "dept", "date", "is_holiday"), "test")
    f = TP.features_table(spark, sf)
    out(f.select("store", "date", "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4",
                 "markdown5", "cpi", "unemployment", "is_holiday"), "features")
    out(TP.stores_table(spark, sf), "stores")


@register("csv_source_roundtrip", Q.with_(Q.panel_cte("nation")) + ", " + Q.split_ctes(unseen=False) +
          " SELECT store, dept, date, weekly_sales, is_holiday FROM train", covers="A1 H1")
def q_csv_roundtrip(spark, sf):
    from ..sources.readers import load_raw_data
    path = shared_path(spark, "csv")
    write_reference_layout(spark, sf, path)
    train, _, _, _ = load_raw_data(spark, path)
    return train


def _run_log_sql() -> str:
    from .q_core import _folds_sql
    return Q.with_(Q.panel_cte("region")) + ", " + _folds_sql() + """,
fs AS (SELECT f.fold, COUNT(*) FILTER (WHERE p.date < f.val_start) AS n_train
       FROM panel p JOIN folds f ON p.date <= f.val_end GROUP BY 1)
SELECT 'folds' AS run, CAST(MAX(CASE WHEN fold = 0 THEN n_train END) AS DOUBLE) AS "0",
  CAST(MAX(CASE WHEN fold = 1 THEN n_train END) AS DOUBLE) AS "1",
  CAST(MAX(CASE WHEN fold = 2 THEN n_train END) AS DOUBLE) AS "2" FROM fs"""


@register("run_log_summary", _run_log_sql(), covers="A5")
def q_run_log(spark, sf):
    p = panel(spark, sf, "region")
    path = shared_path(spark, "runlog")
    per = SP.fold_summary(SP.assign_folds(p, SP.walk_forward_folds(p)))
    SK.log_frame(per, path, "folds", "metric", "fold", "n_train")
    SK.log_metrics(spark, path, "folds", "param", {"n_splits": 3, "horizon_weeks": 38})
    return SK.run_summary(spark, path, "metric")
