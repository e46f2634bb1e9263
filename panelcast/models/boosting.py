"""Boosting that stops with patience, and a search that prunes trials.

MLlib's own early stopping ends at the first tree that does not help. Here a
boosted model is scored at every prefix of its trees on a time-ordered slice
(``evaluateEachIteration``, one pass), the best prefix is kept as a model, and
boosting ends once ``patience`` trees in a row bring nothing. Trees are fitted
in doubling runs: with one seed a longer run repeats a shorter one's trees, so
the result is that of a full run cut the same way, at most twice its cost.

All trials of a search share one encoded table per fold, written once under
the checkpoint folder: label, holiday flag, part and feature vector. A search
by successive halving starts every trial on a small share of its own trees;
the best share of the trials goes on to the next rung. A trial's prefix at a
rung is a prefix of its whole model, so a survivor's last score is that of an
unpruned run.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.metrics import wmae_expr
from ..session import materialize
from .trees import TARGET, assembled_names, category_bins, encoding_stages, gbt, mark_validation, sample_params

PATIENCE = 50
#: Share of the trials that a rung keeps, and of their trees that the rung before uses: 1 / ETA.
ETA = 3
RUNGS = 3


@dataclass
class EncodedFold:
    """One fold's rows as stored feature vectors; ``encoder`` was fitted on its train part."""
    fold: int
    table: DataFrame
    encoder: PipelineModel

    def part(self, *names: str) -> DataFrame:
        return self.table.filter(F.col("part").isin(*names))


def encode_fold(table: DataFrame, fold: Row, features: list[str], stop_weeks: int = 0, date: str = "date") -> EncodedFold:
    """Rows up to the fold's end, encoded by vocabularies of its train part. ``part`` is train, stop (the newest
    ``stop_weeks`` train weeks) or val."""
    before = F.col(date) < F.lit(fold["val_start"])
    train = table.filter(before)
    encoder = Pipeline(stages=encoding_stages(features)).fit(train)
    marked = mark_validation(train, stop_weeks, date) if stop_weeks else train.withColumn("is_validation", F.lit(False))
    val = table.filter(F.col(date).between(F.lit(fold["val_start"]), F.lit(fold["val_end"])))
    parts = marked.withColumn("part", F.when(F.col("is_validation"), F.lit("stop")).otherwise(F.lit("train"))).drop("is_validation")
    rows = parts.unionByName(val.withColumn("part", F.lit("val")))
    return EncodedFold(int(fold["fold"]), materialize(encoder.transform(rows).select("part", TARGET, "is_holiday", "features")), encoder)


def encode_folds(table: DataFrame, folds: DataFrame, features: list[str], stop_weeks: int = 0, date: str = "date") -> list[EncodedFold]:
    return [encode_fold(table, f, features, stop_weeks, date) for f in folds.orderBy("fold").collect()]  # n_splits rows


def prefix_model(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The model of the first ``trees`` trees."""
    if not 1 <= trees <= model.getNumTrees:
        raise ValueError(f"no prefix of {trees} trees")
    whole = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    own_trees = gateway.new_array(regression.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(gateway.jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(list(whole.trees())[:trees], list(whole.treeWeights())[:trees])):
        own_trees[i], weights[i] = tree, weight
    cut = regression.GBTRegressionModel(whole.uid(), own_trees, weights, whole.numFeatures())
    out = GBTRegressionModel(whole.copyValues(cut, whole.extractParamMap()))
    out._transfer_params_from_java()
    return out


def stopping_prefix(errors: list[float], patience: int) -> int:
    """Trees to keep: the first least error before ``patience`` errors in a row that are no less."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_with_patience(train: DataFrame, stop: DataFrame, params: dict, patience: int = PATIENCE, max_bins: int = 32,
                      loss: str = "squared") -> tuple[GBTRegressionModel, list[float]]:
    """(model cut at the best prefix, error of each prefix looked at). At most ``params['maxIter']`` trees."""
    limit = int(params["maxIter"])
    trees = min(limit, 2 * patience)
    if stop.isEmpty():
        raise ValueError("the stopping slice has no rows")
    while True:
        model = gbt({**params, "maxIter": trees}, max_bins=max_bins, loss=loss).fit(train)
        errors = list(model.evaluateEachIteration(stop, loss))
        best = stopping_prefix(errors, patience)
        if trees == limit or best + patience <= trees:
            return prefix_model(model, best), errors[:best + patience]
        trees = min(limit, 2 * trees)


def _in_threads(fn, items: list, parallel: int) -> list:
    if parallel > 1:
        with ThreadPoolExecutor(parallel) as pool:
            return list(pool.map(fn, items))
    return [fn(x) for x in items]


def cv_with_patience(table: DataFrame, folds: DataFrame, features: list[str], params: dict, patience: int = PATIENCE,
                     stop_weeks: int = 13, parallel: int = 1) -> tuple[DataFrame, DataFrame]:
    """Walk-forward scores of the best prefixes, and the path there.

    Returns ``(fold, wmae, n_val, n_trees, n_fitted)`` and ``(fold, n_trees, slice_error, chosen)`` with a row per prefix.
    """
    spark = table.sparkSession
    table = materialize(table)
    bins = category_bins(table, features)

    def run(f: EncodedFold):
        model, errors = fit_with_patience(f.part("train"), f.part("stop"), params, patience, bins)
        s = model.transform(f.part("val")).agg(wmae_expr(TARGET, "y_pred").alias("wmae"), F.count(F.lit(1)).alias("n")).first()
        path = [(f.fold, i + 1, float(e), i + 1 == model.getNumTrees) for i, e in enumerate(errors)]
        return (f.fold, s["wmae"], int(s["n"]), model.getNumTrees, len(errors)), path

    done = _in_threads(run, encode_folds(table, folds, features, stop_weeks), parallel)
    return (spark.createDataFrame([s for s, _ in done], "fold int, wmae double, n_val long, n_trees int, n_fitted int"),
            spark.createDataFrame([r for _, p in done for r in p], "fold int, n_trees int, slice_error double, chosen boolean"))


def fold_wmae(fold: EncodedFold, params: dict, trees: int, max_bins: int) -> float | None:
    """WMAE on the fold's validation rows of ``trees`` trees fitted to its train rows."""
    model = gbt({**params, "maxIter": trees}, max_bins=max_bins).fit(fold.part("train", "stop"))
    return model.transform(fold.part("val")).agg(wmae_expr(TARGET, "y_pred")).first()[0]


def halving_search(table: DataFrame, folds: DataFrame, features: list[str], n_trials: int = 30, seed: int = 42, eta: int = ETA,
                   rungs: int = RUNGS, space: dict | None = None, parallel: int = 1) -> DataFrame:
    """Successive halving over tree prefixes; one row per trial and rung it ran in.

    Rung r of R fits ``1 / eta^(R-1-r)`` of a trial's own trees and keeps the best ``1 / eta`` of its trials by mean
    fold WMAE (ties: lower trial); the last rung fits them whole. Columns: trial, rung, n_trees, mean_wmae, kept,
    params (JSON). The best trial is the least score of the last rung. ``rungs=1`` is the unpruned search.
    """
    spark = table.sparkSession
    table = materialize(table)
    bins = category_bins(table, features)
    encoded = encode_folds(table, folds, features)
    alive = list(enumerate(sample_params(n_trials, seed, space)))
    log = []
    for rung in range(rungs):
        share = eta ** (rungs - 1 - rung)
        jobs = [(t, p, max(1, math.ceil(p["maxIter"] / share)), f) for t, p in alive for f in encoded]
        scores = _in_threads(lambda job: fold_wmae(job[3], job[1], job[2], bins), jobs, parallel)
        by_trial: dict[int, list] = {}
        for (t, *_), s in zip(jobs, scores):
            by_trial.setdefault(t, []).append(s)
        mean = {t: None if any(s is None for s in v) else sum(v) / len(v) for t, v in by_trial.items()}
        order = sorted(alive, key=lambda a: (mean[a[0]] is None, mean[a[0]] or 0.0, a[0]))
        keep = {t for t, _ in order[:max(1, math.ceil(len(order) / eta))]} if rung + 1 < rungs else {order[0][0]}
        log += [(t, rung, max(1, math.ceil(p["maxIter"] / share)), mean[t], t in keep, json.dumps(p, sort_keys=True)) for t, p in alive]
        alive = [(t, p) for t, p in alive if t in keep]
    return spark.createDataFrame(log, "trial int, rung int, n_trees int, mean_wmae double, kept boolean, params string")


def fold_importances(table: DataFrame, folds: DataFrame, features: list[str], params: dict, parallel: int = 1) -> DataFrame:
    """K7: ``fold, feature, importance``, one row per feature (its value, missing flag and index columns together); a fold's add up to 1."""
    table = materialize(table)
    bins = category_bins(table, features)
    names = [n.rsplit("__", 1)[0] for n in assembled_names(features)]

    def run(f: EncodedFold):
        values = gbt(params, max_bins=bins).fit(f.part("train", "stop")).featureImportances.toArray().tolist()
        return [(f.fold, n, float(v)) for n, v in zip(names, values)]

    rows = [r for part in _in_threads(run, encode_folds(table, folds, features), parallel) for r in part]
    return (table.sparkSession.createDataFrame(rows, "fold int, feature string, importance double")
            .groupBy("fold", "feature").agg(F.sum("importance").alias("importance")))


def prune_features(importances: DataFrame, keep: int) -> DataFrame:
    """``feature, importance, rank, kept``: the ``keep`` features of the largest importance summed over folds (ties by name)."""
    total = importances.groupBy("feature").agg(F.sum("importance").alias("importance"))
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # one row per feature
    return total.withColumn("rank", rank).withColumn("kept", F.col("rank") <= keep)


def winner(trials: DataFrame) -> DataFrame:
    """the kept trial of the last rung."""
    last = trials.agg(F.max("rung")).scalar()
    return trials.filter((F.col("rung") == last) & F.col("kept")).select("trial", "n_trees", F.col("params").alias("best_params"),
                                                                        F.col("mean_wmae").alias("best_mean_wmae"))
