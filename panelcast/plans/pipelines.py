"""End-to-end flows: each is a sequence of the operators
above, returned as DataFrames; only model fitting crosses to the driver
(one Spark ML job per fold / step).

* ``tree_flow``        Entry A: merge -> clean -> features -> walk-forward GBT CV
                       -> refit -> clip -> submission rows
* ``window_flow``      Entry B: windows -> normalise + decompose -> per-step linear
                       fits -> validation WMAE and a test forecast with fallbacks
* ``per_series_flow``  Entry C: per-series folds -> AR / additive fits -> WMAE per
                       series and model comparison
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import compare_models, wmae_by
from ..models import additive as AD
from ..models import ar as AR
from ..models import builder as B
from ..models import linear as LN
from ..models import trees as T
from ..operators import fallback as FB
from ..operators import splits as SP
from ..operators import windows as WN
from ..session import materialize


@dataclass
class TreeResult:
    fold_scores: DataFrame
    importances: DataFrame
    submission: DataFrame


def tree_flow(train: DataFrame, test: DataFrame, features: DataFrame, stores: DataFrame, holidays: list[tuple[str, str]],
              feature_cols: list[str] = B.PRUNED_FEATURES, params: dict | None = None,
              n_splits: int = 3, horizon_weeks: int = 38) -> TreeResult:
    """Entry A. ``train``: store, dept, date, weekly_sales, is_holiday; ``test`` the same
    without the target; ``holidays`` has to cover their dates. CV uses the frozen (pipeline) features per fold."""
    train = materialize(train)
    folds = SP.walk_forward_folds(train, n_splits=n_splits, horizon_weeks=horizon_weeks)
    builder = B.PanelFeatureBuilder(features=features, stores=stores, outputFeatures=feature_cols,
                                    holidays=json.dumps(holidays))
    scores = T.cv_pipeline(train, folds, builder, feature_cols, params)
    _, imps = T.cv_flat(B.feature_table(train, features, stores, holidays), folds, feature_cols, params)
    _, pred = T.refit_and_predict(train, test, builder, feature_cols, params)
    return TreeResult(scores, imps, FB.submission_frame(pred))


@dataclass
class WindowResult:
    validation_wmae: DataFrame
    per_series_wmae: DataFrame
    submission: DataFrame


def window_flow(train: DataFrame, test: DataFrame, lookback: int = 52, horizon: int = 13,
                test_horizon: int = 39, reg: float = 0.1, kernel: int = 25) -> WindowResult:
    """Entry B on the global linear window model (K12) with the fallback cascade."""
    train = materialize(train)
    coefs = LN.fit_direct(WN.build_windows(train, lookback, horizon, horizon), horizon, reg, kernel)
    scored = LN.score_windows(LN.predict_windows(WN.validation_windows(train, lookback, horizon, horizon),
                                                 coefs, kernel))
    total = wmae_by(scored, [])
    per_series = wmae_by(scored, ["store", "dept"])
    full = LN.fit_direct(WN.build_windows(train, lookback, test_horizon, 0), test_horizon, reg, kernel)
    inf = WN.inference_windows(train, lookback).filter(F.col("n_x") == lookback)
    fc = LN.predict_windows(inf.withColumn("y", F.array()).withColumn("h", F.array()), full, kernel)
    steps = fc.select("store", "dept", F.posexplode("forecast").alias("step", "y_model"))
    casc = FB.fallback_cascade(test, train, steps, min_len=lookback)
    return WindowResult(total, per_series, FB.submission_frame(casc))


def per_series_flow(panel: DataFrame, calendar: DataFrame | None, n_splits: int = 3,
                    horizon_weeks: int = 13, min_train: int = 30) -> DataFrame:
    """Entry C: mean fold WMAE per series for seasonal AR and the additive model,
    side by side with the improvement in percent (D24)."""
    panel = materialize(panel)
    frame = materialize(AR.fold_frame(panel, n_splits=n_splits, horizon_weeks=horizon_weeks, min_train=min_train))

    def score(pred: DataFrame, model: str) -> DataFrame:
        ok = pred.filter(F.col("error").isNull() & F.col("y_pred").isNotNull())
        per_fold = wmae_by(ok, ["store", "dept", "fold"], "y", "y_pred")
        return (per_fold.groupBy("store", "dept").agg(F.avg("wmae").alias("wmae"))
                .withColumn("model", F.lit(model)))

    a = score(AR.evaluate_ar(frame, (1, 1, 1, 52)), "sar")
    b = score(AD.evaluate_additive(frame, calendar), "additive")
    return compare_models(a.unionByName(b), ["store", "dept"], "model", "wmae", "sar", "additive")
