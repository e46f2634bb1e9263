"""Patience and the pruned search against full runs."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from panelcast.models import boosting as BO
from panelcast.models import trees as T
from panelcast.operators import splits as SP
from panelcast.sources import sinks as SK

FEATURES = ["store", "dept", "week", "month"]
PARAMS = {**T.PRESET_QUICK, "maxDepth": 3, "maxIter": 24, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.66"}


def _weekly(spark, noise):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(3):
        for i in range(170):
            y = 1000 * (s + 1) + 200 * np.sin(2 * np.pi * i / 52) + rng.normal(0, noise)
            rows.append((s, s % 2, dt.date(2010, 2, 5) + dt.timedelta(days=7 * i), float(y), i % 52 in (1, 30)))
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    return df.withColumn("week", F.weekofyear("date")).withColumn("month", F.month("date"))


@pytest.fixture(scope="module")
def panel(spark):
    return _weekly(spark, 120)


@pytest.fixture(scope="module")
def newest(panel):
    fold = SP.walk_forward_folds(panel).orderBy(F.desc("fold")).first()
    return fold, BO.encode_fold(panel, fold, FEATURES, 13)


@pytest.mark.parametrize("errors, patience, want", [
    ([5, 4, 3], 1, 3), ([5, 6, 4], 1, 1), ([5, 6, 4], 2, 3), ([5, 5, 5], 3, 1), ([3], 1, 1), ([5, 6, 7, 8, 1], 3, 1), ([5, 6, 7, 1, 8], 3, 4)])
def test_stopping_prefix(errors, patience, want):
    assert BO.stopping_prefix(errors, patience) == want


def test_parts_are_time_ordered_and_whole(panel, newest):
    fold, enc = newest
    before = panel.filter(F.col("date") < F.lit(fold["val_start"]))
    last = before.agg(F.max("date")).first()[0]
    stop = before.filter(F.col("date") > F.lit(last - dt.timedelta(days=91)))
    assert enc.part("stop").count() == stop.count() > 0
    assert enc.part("train", "stop").count() == before.count()
    assert enc.part("val").count() == panel.filter(F.col("date").between(fold["val_start"], fold["val_end"])).count()


def test_prefix_is_the_shorter_run_and_can_be_stored(newest, tmp_path):
    _, enc = newest
    long = T.gbt(PARAMS).fit(enc.part("train"))
    short = T.gbt({**PARAMS, "maxIter": 7}).fit(enc.part("train"))
    cut = BO.prefix_model(long, 7)
    cut.write().save(str(tmp_path / "cut"))
    want = [r["y_pred"] for r in short.transform(enc.part("val")).collect()]
    for model in (cut, GBTRegressionModel.load(str(tmp_path / "cut"))):
        assert np.allclose([r["y_pred"] for r in model.transform(enc.part("val")).collect()], want)
    assert cut.getNumTrees == 7 and cut.numFeatures == long.numFeatures and cut.getPredictionCol() == "y_pred"
    with pytest.raises(ValueError):
        BO.prefix_model(long, 25)


def test_best_prefix_by_brute_force(newest):
    _, enc = newest
    model, errors = BO.fit_with_patience(enc.part("train"), enc.part("stop"), PARAMS, patience=4)
    # every prefix fitted on its own and scored on the slice by hand
    rows = enc.part("stop").select("weekly_sales", "features")
    want = []
    for k in range(1, len(errors) + 1):
        own = T.gbt({**PARAMS, "maxIter": k}).fit(enc.part("train")).transform(rows)
        want.append(own.agg(F.avg((F.col("weekly_sales") - F.col("y_pred")) ** 2)).first()[0])
    assert np.allclose(errors, want)
    assert model.getNumTrees == int(np.argmin(want)) + 1 < len(errors)


def test_stopping_does_not_depend_on_the_first_run(newest):
    _, enc = newest
    whole = list(T.gbt(PARAMS).fit(enc.part("train")).evaluateEachIteration(enc.part("stop"), "squared"))
    for patience in (1, 2, 6, 40):
        model, errors = BO.fit_with_patience(enc.part("train"), enc.part("stop"), PARAMS, patience=patience)
        assert model.getNumTrees == BO.stopping_prefix(whole, patience)
        assert np.allclose(errors, whole[:len(errors)])
    with pytest.raises(ValueError):
        BO.fit_with_patience(enc.part("train"), enc.part("stop").limit(0), PARAMS)


def test_cv_returns_chosen_prefix_and_path(panel):
    scores, path = BO.cv_with_patience(panel, SP.walk_forward_folds(panel), FEATURES, PARAMS, patience=3, parallel=3)
    chosen = {r["fold"]: r["n_trees"] for r in path.filter("chosen").collect()}
    assert chosen == {r["fold"]: r["n_trees"] for r in scores.collect()} and len(chosen) == 3
    assert {r["fold"]: r["n"] for r in path.groupBy("fold").agg(F.count("*").alias("n")).collect()} == {r["fold"]: r["n_fitted"] for r in scores.collect()}


def test_search_prunes_to_the_unpruned_winner(spark, tmp_path):
    panel = _weekly(spark, 5)  # trials differ by more than the noise
    folds = SP.walk_forward_folds(panel).filter("fold > 0")
    space = {"maxIter": (18, 20), "maxDepth": (2, 4), "stepSize": (0.02, 0.9), "minInstancesPerNode": (1, 5)}
    log = BO.halving_search(panel, folds, FEATURES, n_trials=6, seed=2, space=space, parallel=8)
    full = BO.halving_search(panel, folds, FEATURES, n_trials=6, seed=2, space=space, parallel=8, rungs=1)
    rows, whole = log.collect(), {r["trial"]: r for r in full.collect()}
    assert [sum(r["rung"] == k for r in rows) for k in range(3)] == [6, 2, 1] and len(whole) == 6
    for r in rows:
        assert r["params"] == whole[r["trial"]]["params"] and r["n_trees"] == -(-whole[r["trial"]]["n_trees"] // 3 ** (2 - r["rung"]))
    best = BO.winner(log).first()
    assert np.isclose(best["best_mean_wmae"], whole[best["trial"]]["mean_wmae"])  # a survivor's last score is its whole model's
    assert best["trial"] == min(whole, key=lambda t: whole[t]["mean_wmae"])
    # every trial's parameters and rungs reach the log
    path = str(tmp_path / "log")
    SK.log_params(log.selectExpr("concat('t', trial) AS run", "params").distinct(), path, "run", "params")
    SK.log_runs(log.filter("rung = 0").selectExpr("concat('t', trial) AS run", "mean_wmae"), path, "run", {"mean_wmae": "rung0"})
    back = {r["run"]: r for r in SK.run_summary(spark, path, "param", sorted(T.SEARCH_SPACE)).collect()}
    for t, r in whole.items():
        assert {k: float(v) for k, v in json.loads(r["params"]).items()} == {k: back[f"t{t}"][k] for k in T.SEARCH_SPACE}
    assert SK.run_summary(spark, path, "metric", ["rung0"]).filter("rung0 IS NOT NULL").count() == 6
