"""Property tests: fold tables and window counts against their closed-form semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.operators import splits as SP
from panelcast.operators import windows as WN

D0 = dt.date(2010, 2, 5)


def _expected_folds(dates, n_splits, horizon):
    last, first = max(dates), min(dates)
    kept = []
    for i in range(n_splits):
        end = last - dt.timedelta(days=7 * horizon * i)
        start = end - dt.timedelta(days=7 * horizon)
        if start > first:
            kept.append((start, end))
    kept.reverse()
    return [(k, s, e) for k, (s, e) in enumerate(kept)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(2, 160), n_splits=st.integers(1, 4), horizon=st.integers(1, 40),
       gaps=st.sets(st.integers(1, 158), max_size=10))
def test_walk_forward_folds_match_semantics(spark, n, n_splits, horizon, gaps):
    dates = [D0 + dt.timedelta(days=7 * i) for i in range(n) if i not in gaps or i in (0, n - 1)]
    df = spark.createDataFrame([(d,) for d in dates], "date date")
    got = [(r["fold"], r["val_start"], r["val_end"])
           for r in SP.walk_forward_folds(df, n_splits=n_splits, horizon_weeks=horizon).orderBy("fold").collect()]
    assert got == _expected_folds(dates, n_splits, horizon)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lengths=st.lists(st.integers(1, 120), min_size=1, max_size=4),
       lookback=st.integers(2, 20), horizon=st.integers(1, 8), val=st.integers(0, 8))
def test_window_counts_match_formula(spark, lengths, lookback, horizon, val):
    rows = [(1, d, D0 + dt.timedelta(days=7 * i), float(i), False)
            for d, n in enumerate(lengths, start=1) for i in range(n)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    expected = sum(n - val - horizon - lookback + 1 for n in lengths if n >= lookback + horizon + val)
    assert WN.build_windows(df, lookback, horizon, val).count() == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.integers(-1000, 1000), min_size=1, max_size=300),
       probs=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]), min_size=1, max_size=3, unique=True))
def test_exact_quantiles_match_numpy(spark, vals, probs):
    import numpy as np
    from panelcast.functions.quantiles import exact_quantiles
    df = spark.createDataFrame([(float(v) / 7,) for v in vals], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "x", probs, bins=4).collect()}
    ref = np.quantile(np.array(vals, dtype=float) / 7, probs)
    for p, r in zip(probs, ref):
        assert abs(got[p] - r) <= 1e-9 * max(1.0, abs(r))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.integers(0, 2000), min_size=1, max_size=20))
def test_nearest_holiday_matches_brute_force(spark, days):
    from panelcast.functions.calendar import REFERENCE_HOLIDAYS, days_to_nearest_holiday
    base = dt.date(2009, 6, 1)
    ds = [base + dt.timedelta(days=d) for d in days]
    hol = [dt.date.fromisoformat(h) for _, h in REFERENCE_HOLIDAYS]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    got = [r[0] for r in df.select(days_to_nearest_holiday("d", REFERENCE_HOLIDAYS)).collect()]
    for d, g in zip(ds, got):
        diffs = [(h - d).days for h in hol]
        best = min(range(len(diffs)), key=lambda i: (abs(diffs[i]), i))
        assert g == diffs[best]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(-10**6, 10**6), st.integers(-10**6, 10**6), st.booleans()),
                     min_size=1, max_size=50))
def test_wmae_matches_numpy(spark, rows):
    import numpy as np
    from panelcast.functions.metrics import wmae_expr
    df = spark.createDataFrame([(float(a), float(b), h) for a, b, h in rows], "y double, y_pred double, is_holiday boolean")
    got = df.agg(wmae_expr().alias("w")).first()["w"]
    y = np.array([r[0] for r in rows], dtype=float)
    p = np.array([r[1] for r in rows], dtype=float)
    h = np.array([r[2] for r in rows])
    w = np.where(h, 5, 1)
    assert abs(got - np.sum(w * np.abs(y - p)) / np.sum(w)) <= 1e-9 * max(1.0, abs(got))
