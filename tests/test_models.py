"""Model operators on constructed series (the driver data has no signal to learn)."""

import datetime as dt
import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.calendar import REFERENCE_HOLIDAYS
from panelcast.models import ar as AR
from panelcast.models import builder as B
from panelcast.models import diagnostics as DG
from panelcast.models import linear as LN
from panelcast.models import trees as T
from panelcast.operators import windows as WN

D0 = dt.date(2010, 2, 5)


def _constructed(spark, n_series=4, n=160, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n_series):
        level = 1000 * (s + 1)
        for i in range(n):
            d = D0 + dt.timedelta(days=7 * i)
            hol = i % 52 in (1, 30, 42, 47)
            y = level + 3 * i + 200 * np.sin(2 * np.pi * i / 52) + (300 if hol else 0) + rng.normal(0, 10)
            rows.append((s, 1, d, float(y), bool(hol)))
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")


def test_forecast_ar_recovers_seasonal_pattern():
    i = np.arange(200)
    y = 100 + 2 * i + 50 * np.sin(2 * np.pi * i / 52)
    fc = AR.forecast_ar(y, 13, p=1, d=1, D=1, s=52)
    truth = 100 + 2 * (200 + np.arange(13)) + 50 * np.sin(2 * np.pi * (200 + np.arange(13)) / 52)
    assert np.allclose(fc, truth, atol=1e-6)


def test_dickey_fuller_random_walk_vs_noise(spark):
    rng = np.random.default_rng(5)
    rw = np.cumsum(rng.normal(size=300))
    wn = rng.normal(size=300)
    rows = [(1, 1, D0 + dt.timedelta(days=7 * i), float(v), False) for i, v in enumerate(rw)]
    rows += [(1, 2, D0 + dt.timedelta(days=7 * i), float(v), False) for i, v in enumerate(wn)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    r = {x["dept"]: x["stationary_5pct"] for x in DG.dickey_fuller(df).collect()}
    assert r == {1: False, 2: True}
    k = {x["dept"]: x["stationary_5pct"] for x in DG.adf_test(df, 2).collect()}
    assert k == {1: False, 2: True}


def test_linear_window_model_beats_window_mean(spark):
    df = _constructed(spark)
    coefs = LN.fit_direct(WN.build_windows(df, 52, 13, 13), 13, reg=0.01)
    s = LN.score_windows(LN.predict_windows(WN.validation_windows(df, 52, 13, 13), coefs))
    mae_model = s.agg(F.avg(F.abs(F.col("y") - F.col("y_pred")))).first()[0]
    base = WN.validation_windows(df, 52, 13, 13).select(
        F.explode(F.transform("y", lambda v: F.abs(v - F.col("x_mean")))).alias("e"))
    mae_base = base.agg(F.avg("e")).first()[0]
    assert mae_model < 0.5 * mae_base


def test_one_pass_fit_equals_ridge_on_the_rows(spark):
    # plain loops over the windows: moving average with clamped ends, weight 5 in holiday weeks
    df = _constructed(spark, n_series=2, n=120)
    w = WN.build_windows(df, 20, 3, 3)
    coefs = LN.fit_direct(w, 3, reg=0.1, kernel=5)
    feats, ys, hs = [], [], []
    for r in w.collect():
        xn = [(v - r["x_mean"]) / (r["x_std"] + 1e-6) for v in r["x"]]
        trend = [sum(xn[min(max(j, 0), 19)] for j in range(i - 2, i + 3)) / 5 for i in range(20)]
        feats.append(trend + [v - t for v, t in zip(xn, trend)])
        ys.append([(v - r["x_mean"]) / (r["x_std"] + 1e-6) for v in r["y"]])
        hs.append(r["h"])
    X, Y, W = np.array(feats), np.array(ys), np.where(np.array(hs), 5.0, 1.0)
    for s, (c, b) in enumerate(coefs):
        wt = W[:, s] / W[:, s].sum()
        Xc, yc = X - wt @ X, Y[:, s] - wt @ Y[:, s]
        want = np.linalg.solve(Xc.T @ (Xc * wt[:, None]) + 0.1 * np.eye(40), Xc.T @ (yc * wt))
        assert np.allclose(c, want, atol=1e-6)
        assert np.isclose(b, wt @ Y[:, s] - (wt @ X) @ want, atol=1e-6)
    one = w.limit(1)
    got, r = LN.predict_windows(one, coefs, 5).first()["forecast"], one.first()
    i = [k for k, f in enumerate(w.collect()) if f["origin"] == r["origin"] and f["store"] == r["store"]][0]
    for s, (c, b) in enumerate(coefs):
        assert np.isclose(got[s], (X[i] @ np.array(c) + b) * (r["x_std"] + 1e-6) + r["x_mean"], rtol=1e-9)


def test_windows_of_another_length_get_no_forecast(spark):
    df = _constructed(spark, n_series=1, n=120)
    coefs = LN.fit_direct(WN.build_windows(df, 20, 3, 3), 3)
    short = spark.createDataFrame([([1.0, 2.0], 1.5, 0.5), (None, None, None)], "x array<double>, x_mean double, x_std double")
    assert [r["forecast"] for r in LN.predict_windows(short, coefs).collect()] == [None, None]


def test_builder_frozen_features_ignore_future(spark):
    # T17 frozen mode / T8: serving features must not move when future targets change
    df = _constructed(spark, n_series=2, n=110)
    cut = D0 + dt.timedelta(days=7 * 100)
    train = df.filter(F.col("date") < F.lit(cut))
    val = df.filter(F.col("date") >= F.lit(cut))
    feats = ["store", "dept", "sales_lag_52wk", "dept_avg_sales_expanding", "store_avg_sales_expanding"]
    b = B.PanelFeatureBuilder(outputFeatures=feats, holidays=json.dumps(REFERENCE_HOLIDAYS))
    a = b.fit(train).transform(val).orderBy("store", "date").toPandas()
    perturbed = val.withColumn("weekly_sales", F.col("weekly_sales") * 1000)
    c = b.fit(train).transform(perturbed).orderBy("store", "date").toPandas()
    for f in feats[2:]:
        assert np.allclose(a[f].to_numpy(dtype=float), c[f].to_numpy(dtype=float), equal_nan=True)


def test_pipeline_save_load_roundtrip(spark):
    df = _constructed(spark, n_series=3, n=120)
    feats = ["store", "dept", "month", "week", "sales_lag_52wk", "days_to_nearest_holiday",
             "dept_avg_sales_expanding", "store_avg_sales_expanding"]
    builder = B.PanelFeatureBuilder(outputFeatures=feats, holidays=json.dumps(REFERENCE_HOLIDAYS))
    train = df.filter(F.col("date") < F.lit(D0 + dt.timedelta(days=7 * 100)))
    test = df.filter(F.col("date") >= F.lit(D0 + dt.timedelta(days=7 * 100))).drop("weekly_sales")
    model, pred = T.refit_and_predict(train, test, builder, feats, {**T.PRESET_QUICK, "maxIter": 5})
    path = os.path.join(tempfile.mkdtemp(prefix="pc-model-"), "m")
    model.write().overwrite().save(path)
    again = T.score_saved(path, test)
    a = pred.select("store", "date", "y_pred").toPandas().sort_values(["store", "date"])
    b = again.select("store", "date", "y_pred").toPandas().sort_values(["store", "date"])
    assert len(a) == test.count() and np.allclose(a["y_pred"], b["y_pred"])
    assert (a["y_pred"] >= 0).all()


def test_gbt_rejects_nothing_with_nulls(spark):
    df = _constructed(spark, n_series=2, n=60).withColumn(
        "x", F.when(F.col("weekly_sales") > 1500, F.col("weekly_sales")))
    stages = T.encoding_stages(["store", "x"])
    out = stages[0].transform(df)
    assert out.filter(F.col("x__missing") == 1.0).count() == df.filter(F.col("x").isNull()).count()
    assert out.filter(F.col("x__num").isNull()).count() == 0


def test_order_choice_prefers_ar1(spark):
    rng = np.random.default_rng(9)
    e = rng.normal(size=400)
    y = np.zeros(400)
    for t in range(1, 400):
        y[t] = 0.8 * y[t - 1] + e[t]
    rows = [(1, 1, D0 + dt.timedelta(days=7 * i), float(v), False) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    r = AR.choose_order(AR.order_grid(df, 3), DG.dickey_fuller(df)).first()
    assert r["d"] == 0 and r["p"] >= 1


def test_additive_model_fits_constructed_series(spark):
    from panelcast.functions.calendar import holiday_frame
    from panelcast.models import additive as AD
    from panelcast.operators import splits as SP
    df = _constructed(spark, n_series=2, n=160)
    folds = SP.per_series_folds(df, n_splits=1, horizon_weeks=13, min_train=30)
    frame = AR.fold_frame(df, folds)
    pred = AD.evaluate_additive(frame, None, fourier_order=5, ridge=0.01).toPandas()
    assert pred["error"].isna().all() and len(pred) > 0
    mae = (pred["y"] - pred["y_pred"]).abs().mean()
    assert mae < 120  # holiday bumps (300) are not in the design here; trend + season are


def test_multiplicative_model_on_positive_series(spark):
    from panelcast.models import additive as AD
    from panelcast.operators import splits as SP
    df = _constructed(spark, n_series=2, n=160)
    folds = SP.per_series_folds(df, n_splits=1, horizon_weeks=13, min_train=30)
    pred = AD.evaluate_additive(AR.fold_frame(df, folds), None, fourier_order=5, ridge=0.01,
                                multiplicative=True).toPandas()
    assert pred["error"].isna().all()
    rel = ((pred["y"] - pred["y_pred"]).abs() / pred["y"]).mean()
    assert rel < 0.1


def test_future_dates_and_series_guard(spark):
    from panelcast.models import additive as AD
    df = _constructed(spark, n_series=2, n=10)
    f = AD.future_dates(df, 3)
    assert f.count() == 2 * 13 and f.filter("is_future").count() == 6


def test_gbt_early_stopping_runs(spark):
    df = _constructed(spark, n_series=2, n=120)
    feats = ["store", "dept", "sales_lag_52wk", "dept_avg_sales_expanding"]
    from panelcast.operators import features as FE
    t = FE.add_expanding_dept_avg(FE.add_prior_year_sales(df))
    t = T.mark_validation(t, 13)
    model = T.tree_pipeline(feats, {**T.PRESET_QUICK, "maxIter": 30}, validation_col="is_validation").fit(t)
    assert model.stages[-1].getNumTrees <= 30


def test_native_ar1_equals_grouped_fit(spark):
    df = _constructed(spark, n_series=3, n=150)
    gappy = df.filter(~((F.col("store") == 1) & F.dayofmonth("date").between(8, 10)))
    frame = AR.fold_frame(gappy, n_splits=2, horizon_weeks=13, min_train=30)
    for seasonal in (True, False):
        a = {(r["store"], r["fold"], r["date"]): r for r in AR.evaluate_ar(frame, (1, 1, int(seasonal), 52)).collect()}
        b = {(r["store"], r["fold"], r["date"]): r for r in AR.evaluate_ar1(frame, seasonal).collect()}
        assert a.keys() == b.keys() and len(a) > 0
        for k in a:
            assert np.isclose(a[k]["y_pred"], b[k]["y_pred"], rtol=1e-8) and a[k]["y"] == b[k]["y"] and b[k]["error"] is None


def test_native_ar1_short_fold_keeps_its_rows_with_an_error(spark):
    df = _constructed(spark, n_series=1, n=60)
    frame = AR.fold_frame(df, n_splits=1, horizon_weeks=13, min_train=30)
    rows = AR.evaluate_ar1(frame).collect()
    assert len(rows) >= 13 and all(r["y_pred"] is None and r["error"] == "too few observations for AR order" for r in rows)


def _planted_windows(spark, n, outliers, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=12)
        y = [0.8 * x[-1] - 0.3 * x[-4] + 0.1, 0.5 * x[-2] + 0.2 * x[0]]
        if outliers and i % 9 == 0:
            y = [v + 40 for v in y]
        rows.append((x.tolist(), [float(v) for v in y], [i % 5 == 0, i % 7 == 0], 0.0, 1.0))
    return spark.createDataFrame(rows, "x array<double>, y array<double>, h array<boolean>, x_mean double, x_std double").repartition(3)


def test_absolute_loss_falls_and_withstands_outliers(spark):
    w = _planted_windows(spark, 400, outliers=True)
    fit = LN.fit_absolute(w, 2, reg=1e-6, kernel=5, max_rounds=60)
    goals = [o for _, o in fit.rounds]
    assert fit.converged and len(goals) > 3 and all(b <= a * (1 + 1e-12) for a, b in zip(goals, goals[1:]))
    clean = _planted_windows(spark, 60, outliers=False, seed=11)
    err = lambda coefs: LN.predict_windows(clean, coefs, 5).select(F.explode(F.zip_with("y", "forecast", lambda a, b: F.abs(a - b))).alias("e")).agg(F.avg("e")).first()[0]
    assert err(fit.coefs) < 0.01 < 1 < err(LN.fit_direct(w, 2, reg=1e-6, kernel=5))


def test_reweighting_rounds_equal_plain_loops(spark):
    w = _planted_windows(spark, 90, outliers=True)
    fit = LN.fit_absolute(w, 2, reg=0.05, kernel=3, delta=0.01, max_rounds=4, tol=0.0)
    rows = w.collect()
    for s in range(2):
        X = np.array([[sum(r["x"][min(max(j, 0), 11)] for j in (i - 1, i, i + 1)) / 3 for i in range(12)] for r in rows])
        X = np.hstack([X, np.array([r["x"] for r in rows]) - X])
        Y, hw = np.array([r["y"][s] for r in rows]), np.array([5.0 if r["h"][s] else 1.0 for r in rows])
        wt, c, b = hw, None, None
        for _ in range(5):
            mx, my = (wt @ X) / wt.sum(), (wt @ Y) / wt.sum()
            c = np.linalg.solve((X - mx).T @ ((X - mx) * wt[:, None]) / hw.sum() + 0.05 * np.eye(24), (X - mx).T @ ((Y - my) * wt) / hw.sum())
            b = my - mx @ c
            wt = hw / np.sqrt((Y - X @ c - b) ** 2 + 0.01 ** 2)
        assert np.allclose(fit.coefs[s][0], c, atol=1e-4) and np.isclose(fit.coefs[s][1], b, atol=1e-4)


def test_updated_builder_equals_one_fit(spark, tmp_path):
    from pyspark.ml import PipelineModel
    df = _constructed(spark, n_series=3, n=130)
    extra = spark.createDataFrame([(9, 7, D0 + dt.timedelta(days=7 * 110), None, False), (9, 8, D0 + dt.timedelta(days=7 * 3), 5.0, True)], df.schema)
    df = df.unionByName(extra)
    cuts = [D0 + dt.timedelta(days=7 * k) for k in (60, 61, 118)]
    test = df.filter(F.col("date") >= F.lit(cuts[2]))
    feats = ["store", "dept", "sales_lag_52wk", "dept_avg_sales_expanding", "store_avg_sales_expanding"]
    b = B.PanelFeatureBuilder(outputFeatures=feats, holidays=json.dumps(REFERENCE_HOLIDAYS))
    part = lambda lo, hi: df.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    whole = b.fit(part(D0, cuts[2]))
    split = b.fit(part(D0, cuts[0])).update(part(cuts[0], cuts[1])).update(part(cuts[1], cuts[2])).update(df.limit(0))
    PipelineModel(stages=[split]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0].update(df.limit(0))
    frames = [m.transform(test).orderBy("store", "dept", "date").toPandas() for m in (whole, split, again)]
    for f in feats[2:]:
        for other in frames[1:]:
            assert np.allclose(frames[0][f].to_numpy(dtype=float), other[f].to_numpy(dtype=float), equal_nan=True)
    assert frames[0]["sales_lag_52wk"].notna().any()


def test_native_ar1_over_folds_equals_the_frame_form(spark):
    from panelcast.operators.grid import densify_ffill
    from panelcast.operators.splits import series_fold_bounds
    df = _constructed(spark, n_series=3, n=150)
    short = spark.createDataFrame([(7, 1, D0 + dt.timedelta(days=7 * i), float(i), False) for i in range(40)], df.schema)
    df = df.filter(~((F.col("store") == 1) & F.dayofmonth("date").between(8, 10))).unionByName(short)
    dense, folds = densify_ffill(df), series_fold_bounds(df, n_splits=2, horizon_weeks=13)
    frame = AR.fold_frame(df, n_splits=2, horizon_weeks=13, min_train=30)
    for seasonal in (True, False):
        a = {(r["store"], r["fold"], r["date"]): r for r in AR.evaluate_ar1(frame, seasonal).collect()}
        b = {(r["store"], r["fold"], r["date"]): r for r in AR.evaluate_ar1_folds(dense, folds, seasonal).collect()}
        assert a.keys() == b.keys() and len(a) > 0
        for k in a:
            assert a[k]["error"] == b[k]["error"] and a[k]["y"] == b[k]["y"]
            assert a[k]["y_pred"] is None and b[k]["y_pred"] is None or np.isclose(a[k]["y_pred"], b[k]["y_pred"], rtol=1e-9)
