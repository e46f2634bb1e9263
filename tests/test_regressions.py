"""Least squares in column functions, and what stands on it, against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions import linalg as LA
from panelcast.models import ar as AR
from panelcast.models import diagnostics as DG
from panelcast.operators.grid import densify_ffill
from panelcast.operators.splits import series_fold_bounds

D0 = dt.date(2008, 2, 1)
SCHEMA = "store int, dept int, date date, weekly_sales double, is_holiday boolean"


def frame(spark, series):
    rows = [(s, d, D0 + dt.timedelta(days=7 * i), None if v is None else float(v), False) for (s, d), y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, SCHEMA)


def test_sweep_solves_nested_regressions(spark):
    rng = np.random.default_rng(0)
    X, y = rng.normal(size=(60, 4)) * [1, 50, 0.1, 3] + 7, rng.normal(size=60)
    rows = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(X, y)], "a double, b double, c double, d double, y double")
    rows = rows.unionByName(spark.createDataFrame([(1.0, None, 2.0, 3.0, 4.0)], rows.schema))  # a row with a null takes no part
    g = rows.agg(LA.gram([F.col(c) for c in "abcdy"]).alias("g"))
    for k in range(1, 5):
        m = np.array(g.select(LA.regressed(F.col("g"), k).alias("m")).first()["m"])
        beta, res, *_ = np.linalg.lstsq(X[:, :k], y, rcond=None)
        assert np.allclose(m[:k, 4], beta) and np.isclose(m[4, 4], res[0])
        assert np.allclose(-m[:k, :k], np.linalg.inv(X[:, :k].T @ X[:, :k]))


def test_singular_and_empty_sums_give_nulls(spark):
    twice = spark.createDataFrame([(float(i), 2.0 * i, 1.0) for i in range(9)], "a double, b double, y double")
    m = twice.agg(LA.gram([F.col("a"), F.col("b"), F.col("y")]).alias("g")).select(LA.regressed(F.col("g"), 2).alias("m")).first()["m"]
    assert m[0][2] is None and m[2][2] is None
    m = twice.limit(0).agg(LA.gram([F.col("a"), F.col("y")]).alias("g")).select(LA.regressed(F.col("g"), 1).alias("m")).first()["m"]
    assert m[0][1] is None


def test_quadratic_form(spark):
    rng = np.random.default_rng(1)
    a, g = rng.normal(size=(2, 3)), rng.normal(size=(3, 3))
    g = g + g.T
    row = spark.createDataFrame([(a.tolist(), g.tolist())], "a array<array<double>>, g array<array<double>>")
    assert np.allclose(row.select(LA.quadratic(F.col("a"), F.col("g")).alias("q")).first()["q"], a @ g @ a.T)


def adf_by_rows(y, lags, max_lag):
    dy = np.diff(y)
    t = np.arange(max_lag, len(dy))
    X = np.column_stack([np.ones(len(t)), y[t], *[dy[t - k] for k in range(1, lags + 1)]])
    beta, res, *_ = np.linalg.lstsq(X, dy[t], rcond=None)
    s2 = res[0] / (len(t) - X.shape[1])
    return len(t) * np.log(res[0] / len(t)) + 2 * X.shape[1], beta[1] / np.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1]), len(t)


def test_adf_auto_by_rows(spark):
    rng = np.random.default_rng(2)
    series = {(1, 1): np.cumsum(rng.normal(size=200)) + 500, (1, 2): rng.normal(size=150) * 1e4 + 1e5, (2, 1): np.zeros(60), (2, 2): rng.normal(size=14)}
    ar = np.zeros(260)
    for t in range(3, 260):
        ar[t] = 0.4 * ar[t - 1] + 0.3 * ar[t - 3] + rng.normal()
    series[3, 1] = ar
    got = {(r["store"], r["dept"]): r for r in DG.adf_auto(frame(spark, series), 8).collect()}
    assert got.keys() == series.keys()
    for k in ((1, 1), (1, 2), (3, 1)):
        want = min((*adf_by_rows(series[k], p, 8)[:1], p) for p in range(9))
        assert got[k]["lags"] == want[1]
        _, stat, n = adf_by_rows(series[k], want[1], 8)
        assert np.isclose(got[k]["adf_stat"], stat) and got[k]["n"] == n and got[k]["error"] is None
    assert got[1, 2]["stationary_5pct"] and all(r["stationary_5pct"] == (r["p_value"] < 0.05) for r in got.values() if r["p_value"] is not None)
    assert got[2, 1]["adf_stat"] is None and got[2, 1]["error"] == "no unique fit"
    assert got[2, 2]["lags"] is None and got[2, 2]["error"] == DG.TOO_SHORT
    fixed = {(r["store"], r["dept"]): r for r in DG.adf_test(frame(spark, series), 4).collect()}
    assert np.isclose(fixed[3, 1]["adf_stat"], adf_by_rows(ar, 4, 4)[1]) and fixed[2, 2]["error"] is None


def test_p_values_at_published_points(spark):
    # Percentage points of the statistic with constant (Fuller), large samples.
    table = [(-3.43, 0.01), (-3.12, 0.025), (-2.86, 0.05), (-2.57, 0.10), (-0.44, 0.90), (-0.07, 0.95), (0.23, 0.975), (0.60, 0.99)]
    rows = spark.createDataFrame([(s, p) for s, p in table], "s double, p double")
    for r in rows.select("p", DG.mackinnon_p_value(F.col("s")).alias("got")).collect():
        assert abs(r["got"] - r["p"]) < 0.005
    ends = spark.createDataFrame([(-30.0,), (5.0,), (None,)], "s double").select(DG.mackinnon_p_value(F.col("s")).alias("p")).collect()
    assert [r["p"] for r in ends] == [0.0, 1.0, None]


def test_partial_autocorrelation_by_yule_walker(spark):
    rng = np.random.default_rng(3)
    y = np.zeros(300)
    for t in range(2, 300):
        y[t] = 0.6 * y[t - 1] - 0.3 * y[t - 2] + rng.normal()
    acf = DG.autocorrelation(frame(spark, {(1, 1): y, (1, 2): np.ones(50)}), 10)
    got = {(r["dept"], r["lag"]): r["pacf"] for r in DG.partial_autocorrelation(acf).collect()}
    r = {x["lag"]: x["acf"] for x in acf.filter("dept = 1").collect()}
    for k in range(1, 11):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert np.isclose(got[1, k], np.linalg.solve(R, [r[i] for i in range(1, k + 1)])[-1])
    assert got[1, 0] == 1.0 and all(got[2, k] is None for k in range(1, 11))  # no spread: no correlation


def test_order_grid_by_rows_and_short_series_stay(spark):
    rng = np.random.default_rng(4)
    series = {(1, 1): rng.normal(size=90).cumsum(), (1, 2): [1.0, 2.0, 4.0], (1, 3): rng.normal(size=40)}
    df = frame(spark, series)
    grid = AR.order_grid(df, 3)
    got = {(r["dept"], r["d"], r["p"]): r for r in grid.collect()}
    assert len(got) == 3 * 2 * 4
    for dept in (1, 3):
        for d in (0, 1):
            z = np.diff(series[1, dept], n=d)
            for p in range(4):
                X = np.column_stack([np.ones(len(z) - 3), *[z[3 - j:len(z) - j] for j in range(1, p + 1)]])
                r = z[3:] - X @ np.linalg.lstsq(X, z[3:], rcond=None)[0]
                assert np.isclose(got[dept, d, p]["aic"], len(r) * np.log(r @ r / len(r)) + 2 * (p + 1))
    chosen = {r["dept"]: r for r in AR.choose_order(grid, DG.dickey_fuller(df)).collect()}
    assert set(chosen) == {1, 2, 3}
    assert chosen[2]["p"] is None and chosen[2]["aic"] is None and chosen[2]["error"] == "too few observations for AR order"
    assert chosen[1]["error"] is None and chosen[1]["d"] == 1 and chosen[3]["d"] == 0


def two_stage(z, s, long_ar=4):
    """The fit written out: long autoregression, its residuals, then the regression on their lags."""
    deep = max(long_ar + 1, s + long_ar) if s else long_ar + 1
    t = np.arange(deep, len(z))
    X = np.column_stack([np.ones(len(t)), *[z[t - k] for k in range(1, long_ar + 1)]])
    b = np.linalg.lstsq(X, z[t], rcond=None)[0]
    e = lambda at: z[at] - b[0] - sum(b[k] * z[at - k] for k in range(1, long_ar + 1))
    X2 = np.column_stack([np.ones(len(t)), z[t - 1], e(t - 1), *([e(t - s)] if s else [])])
    return b, np.linalg.lstsq(X2, z[t], rcond=None)[0], len(t)


def seasonal_series(n, phi=0.5, theta=0.4, big=-0.6, seed=5):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 60) * 10
    z = np.zeros(n + 60)
    for t in range(53, n + 60):
        z[t] = phi * z[t - 1] + e[t] + theta * e[t - 1] + big * e[t - 52]
    level = np.cumsum(z[60:])
    y = np.zeros(n)
    for t in range(n):
        y[t] = level[t] + (y[t - 52] if t >= 52 else 1000)
    return y


@pytest.mark.parametrize("seasonal", [True, False])
def test_two_stage_fit_and_forecast_by_rows(spark, seasonal):
    series = {(1, 1): seasonal_series(260), (2, 1): seasonal_series(240, seed=6), (3, 1): seasonal_series(90, seed=7)}
    dense = densify_ffill(frame(spark, series))
    folds = series_fold_bounds(dense.select("store", "dept", "date"), n_splits=2, horizon_weeks=13)
    bounds = {(r["store"], r["fold"]): r for r in folds.collect()}
    fits = {(r["store"], r["fold"]): r for r in AR.arma_fits(dense, folds, seasonal).collect()}
    out = {}
    for r in AR.evaluate_arma(dense, folds, seasonal).collect():
        out.setdefault((r["store"], r["fold"]), {})[r["date"]] = r
    assert fits.keys() == bounds.keys() == out.keys()
    for (store, fold), b in bounds.items():
        y = series[store, 1][:(b["val_start"] - D0).days // 7]
        level = y[52:] - y[:-52] if seasonal else y
        z = np.diff(level)
        f, rows = fits[store, fold], out[store, fold]
        assert len(rows) == 14 or fold == 0 and len(rows) >= 13
        if len(z) < 30 + (56 if seasonal else 5):
            assert f["error"] and f["phi"] is None and all(r["y_pred"] is None and r["error"] for r in rows.values())
            continue
        long, coef, n = two_stage(z, 52 if seasonal else 0)
        assert f["n"] == n and np.allclose(f["long"], long)
        assert np.allclose([f["intercept"], f["phi"], f["theta"]] + ([f["seasonal_theta"]] if seasonal else []), coef)
        e = [0.0] * 4 + [z[i] - long[0] - sum(long[k] * z[i - k] for k in range(1, 5)) for i in range(4, len(z))]
        zk, lev, hist = z[-1], level[-1], list(y)
        for k in range(1, len(rows) + 1):
            at = len(z) + k - 1
            zk = coef[0] + coef[1] * zk + (coef[2] * e[-1] if k == 1 else 0) + (coef[3] * e[at - 52] if seasonal else 0)
            lev += zk
            day = b["val_start"] + dt.timedelta(days=7 * (k - 1))
            assert np.isclose(rows[day]["y_pred"], lev + (hist[len(y) + k - 1 - 52] if seasonal else 0)), k


def test_planted_terms_are_found(spark):
    dense = densify_ffill(frame(spark, {(1, 1): seasonal_series(2200, seed=9)}))
    folds = series_fold_bounds(dense.select("store", "dept", "date"), n_splits=1, horizon_weeks=13)
    f = AR.arma_fits(dense, folds, long_ar=(1, 2, 3, 4, 5, 6, 52, 53, 54)).first()
    assert abs(f["phi"] - 0.5) < 0.15 and abs(f["theta"] - 0.4) < 0.2 and abs(f["seasonal_theta"] + 0.6) < 0.15
