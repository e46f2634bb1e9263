"""Grids and sliding windows: closed-form counts (I8-I10), numpy cross-checks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import diagnostics as DG
from panelcast.operators import grid as G
from panelcast.operators import windows as WN

D0 = dt.date(2010, 2, 5)


def _series(spark, lengths, gap_at=None, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for dept, n in enumerate(lengths, start=1):
        for i in range(n):
            if gap_at is not None and i == gap_at and n > gap_at + 1:
                continue
            rows.append((1, dept, D0 + dt.timedelta(days=7 * i), float(rng.integers(1, 10000)), i % 13 == 0))
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")


def test_window_counts_closed_form(spark):
    df = _series(spark, [143])
    assert WN.build_windows(df, 52, 13, 13).count() == 66
    assert WN.validation_windows(df, 52, 13, 13).count() == 1
    assert WN.build_windows(df, 52, 39, 0).count() == 53


@pytest.mark.parametrize("n, expected", [(1, 0), (51, 0), (52, 0), (77, 0), (78, 1)])
def test_short_series_windows(spark, n, expected):
    df = _series(spark, [n])
    assert WN.build_windows(df, 52, 13, 13).count() == expected
    assert WN.validation_windows(df, 52, 13, 13).count() == expected


def test_window_contents(spark):
    # Windows are row-contiguous; T4: population std of the lookback
    df = _series(spark, [80])
    w = WN.build_windows(df, 52, 13, 13).orderBy("origin").first()
    ys = [r["weekly_sales"] for r in df.orderBy("date").collect()]
    assert w["x"] == ys[:52] and w["y"] == ys[52:65]
    assert w["x_mean"] == pytest.approx(np.mean(ys[:52]))
    assert w["x_std"] == pytest.approx(np.std(ys[:52]))


def test_moving_average_and_normalisation_vs_numpy(spark):
    x = np.random.default_rng(1).normal(100, 20, 52)
    df = spark.createDataFrame([(x.tolist(),)], "x array<double>")
    trend, seasonal = WN.decompose(F.col("x"), 25)
    xn, m, s = WN.instance_normalize(F.col("x"))
    r = df.select(trend.alias("t"), seasonal.alias("s"), xn.alias("xn")).first()
    p = np.concatenate([np.repeat(x[0], 12), x, np.repeat(x[-1], 12)])
    t = np.array([p[i:i + 25].mean() for i in range(52)])
    assert np.allclose(r["t"], t, atol=1e-9) and np.allclose(r["s"], x - t, atol=1e-9)
    assert np.allclose(r["xn"], (x - x.mean()) / (x.std() + 1e-6), atol=1e-9)


def test_reindex_global_fills(spark):
    # Inserted weeks get target 0 and holiday flag False
    df = _series(spark, [10, 6], gap_at=3)
    g = G.reindex_global(df)
    assert g.count() == 2 * 10
    filled = g.filter("is_filled")
    assert filled.filter("weekly_sales != 0 OR is_holiday").count() == 0
    assert filled.count() == 20 - df.count()


def test_densify_ffill(spark):
    df = _series(spark, [8], gap_at=3)
    d = G.densify_ffill(df).orderBy("date").collect()
    assert len(d) == 8 and d[3]["weekly_sales"] == d[2]["weekly_sales"]


def test_pad_if_short(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    assert df.select(G.pad_if_short(F.col("a"), 4)).first()[0] == [0.0, 0.0, 1.0, 2.0]


def test_seasonal_decompose_vs_numpy(spark):
    n = 130
    rng = np.random.default_rng(2)
    y = 1000 + 10 * np.arange(n) + 100 * np.sin(2 * np.pi * np.arange(n) / 52) + rng.normal(0, 5, n)
    rows = [(1, 1, D0 + dt.timedelta(days=7 * i), float(v), False) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    out = DG.seasonal_decompose(df, 52).orderBy("date").toPandas()
    filt = np.r_[0.5, np.ones(51), 0.5] / 52
    tr = np.full(n, np.nan)
    for t in range(26, n - 26):
        tr[t] = (y[t - 26:t + 27] * filt).sum()
    det = y - tr
    idx = np.array([np.nanmean(det[p::52]) for p in range(52)])
    idx -= idx.mean()
    assert np.allclose(out["trend"].to_numpy(dtype=float), tr, equal_nan=True, atol=1e-6)
    assert np.allclose(out["seasonal"].to_numpy(dtype=float), idx[np.arange(n) % 52], atol=1e-6)


def test_acf_vs_numpy_and_pacf_ar1(spark):
    rng = np.random.default_rng(3)
    e = rng.normal(size=300)
    y = np.zeros(300)
    for t in range(1, 300):
        y[t] = 0.7 * y[t - 1] + e[t]
    rows = [(1, 1, D0 + dt.timedelta(days=7 * i), float(v), False) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    acf = DG.autocorrelation(df, 10)
    got = acf.orderBy("lag").toPandas()["acf"].to_numpy()
    z = y - y.mean()
    ref = np.array([(z[k:] * z[:len(z) - k]).sum() / (z * z).sum() for k in range(11)])
    assert np.allclose(got, ref, atol=1e-12)
    pacf = DG.partial_autocorrelation(acf).orderBy("lag").toPandas()["pacf"].to_numpy()
    assert abs(pacf[1] - ref[1]) < 1e-12 and np.all(np.abs(pacf[2:]) < 0.2)
