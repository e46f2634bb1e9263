"""Sparse trend changes: optimal by their own conditions, and planted changes found."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from panelcast.functions.calendar import holiday_frame
from panelcast.models import changes as CH

D0 = dt.date(2012, 1, 6)
SCHEMA = "store int, dept int, fold int, date date, y double, is_holiday boolean, role string"


def _frame(spark, series, n_val=8):
    rows = []
    for s, y in series.items():
        for i, v in enumerate(y):
            rows.append((s, 1, 0, D0 + dt.timedelta(days=7 * i), None if v is None else float(v), False, "val" if i >= len(y) - n_val else "train"))
    return spark.createDataFrame(rows, SCHEMA)


def _planted(n, changes, noise, seed, season=0.0):
    rng = np.random.default_rng(seed)
    u = np.arange(n) / (n - 9)
    y = 100 + 20 * u + sum(size * np.maximum(0, u - at) for at, size in changes) + noise * rng.normal(size=n)
    days = np.array([(D0 - dt.date(1970, 1, 1)).days + 7 * i for i in range(n)])
    return y + season * np.sin(days * 2 * np.pi / 365.25)


def test_conditions_of_the_minimum(spark):
    series = {1: _planted(180, [(0.3, 150)], 4, 1, 10), 2: _planted(150, [], 10, 2), 3: _planted(200, [(0.2, -90), (0.6, 200)], 2, 3, 5), 4: [1.0] * 12}
    cal = holiday_frame(spark, [("a", "2012-03-02"), ("a", "2013-03-01"), ("b", "2012-11-23"), ("b", "2014-11-28")])
    design, free, hinges = CH.trend_design(_frame(spark, series), cal, 2, 6)
    fits = {r["store"]: r for r in CH.sparse_trend(CH.trend_products(design, [*free, *hinges]), len(free), len(hinges), l1=0.02, ridge=0.5, rounds=400).collect()}
    rows = design.filter("role = 'train'").orderBy("date").toPandas()
    assert fits[4]["coefs"] is None and fits[4]["error"] == "fold guard: train < 30 rows"
    for s in (1, 2, 3):
        own = rows[rows["store"] == s]
        X, y = own[[*free, *hinges]].to_numpy(dtype=float), own["y"].to_numpy()
        beta, lam = np.array(fits[s]["coefs"]), fits[s]["penalty"]
        assert np.isclose(lam, 0.02 * len(y) * y.std())
        slope = X.T @ (y - X @ beta)
        ridge = np.array([0.0, 0.0] + [0.5] * (len(free) - 2))
        assert np.allclose(slope[:len(free)], ridge * beta[:len(free)], atol=1e-5 * lam + 1e-6)
        for g, b in zip(slope[len(free):], beta[len(free):]):
            assert abs(g - lam * np.sign(b)) < 2e-3 * lam if b else abs(g) <= lam * 1.002


def test_planted_changes_are_found_and_no_others(spark):
    at = CH.place(5, 12)
    design, free, hinges = CH.trend_design(_frame(spark, {1: _planted(300, [(at, 300)], 0.3, 4, 8), 2: _planted(300, [], 0.3, 5, 8)}), None, 3, 12)
    fits = CH.sparse_trend(CH.trend_products(design, [*free, *hinges]), len(free), len(hinges), l1=0.002)
    got = CH.change_points(fits, len(free), len(hinges)).collect()
    day = D0 + dt.timedelta(days=round(at * 7 * 291))
    assert {r["store"] for r in got} == {1} and len(got) <= 3
    # neighbouring hinges share a change: all within one step of the planted day, their mean at it
    step = 0.8 / 13 * 7 * 291
    size = sum(r["slope_change"] for r in got)
    mean = sum((r["date"] - day).days * r["slope_change"] for r in got) / size
    assert all(abs((r["date"] - day).days) <= 2 * step + 1 and r["slope_change"] > 0 for r in got) and abs(mean) <= step
    assert abs(size / (300 / (7 * 291) * 365.25) - 1) < 0.2


def test_forecasts_follow_the_last_slope_and_failures_stay(spark):
    y = _planted(220, [(0.4, 120)], 1, 6, 5)
    got = CH.evaluate_sparse(_frame(spark, {1: y, 2: [3.0] * 20}), None, l1=0.005).collect()
    ok, short = [r for r in got if r["store"] == 1], [r for r in got if r["store"] == 2]
    assert len(ok) == 8 and np.mean([abs(r["y"] - r["y_pred"]) for r in ok]) < 6
    assert len(short) == 8 and all(r["y_pred"] is None and r["error"] for r in short)
