"""Window features on small random panels against loops over dictionaries.

A panel is a dict ``(store, dept) -> {week number: cents}``; expected values
are worked out per cell from the written rules, in exact fractions.
"""

import datetime as dt
import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from panelcast.functions.calendar import REFERENCE_HOLIDAYS
from panelcast.operators import features as FE
from panelcast.operators import frozen as FZ
from panelcast.operators import prep as P

FRIDAY = dt.date(2010, 1, 1)


def day(week):
    return FRIDAY + dt.timedelta(weeks=week)


def draw(seed, weeks):
    r = random.Random(seed)
    return {(s, d): {w: r.randint(-50_000, 10_000_000) for w in range(r.randrange(10), weeks) if r.random() > 0.15}
            for s in range(3) for d in range(3)}


def frame(spark, panel):
    rows = [(s, d, day(w), c / 100.0, w % 9 == 0) for (s, d), cells in panel.items() for w, c in cells.items()]
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")


def close(got, want):
    return got is None if want is None else got is not None and math.isclose(got, float(want), rel_tol=1e-9, abs_tol=1e-6)


def mean(values):
    return Fraction(sum(values), len(values)) if values else None


def earlier_means(panel, side):
    """(group, week) -> mean over earlier weeks of the group's mean in each week."""
    weekly = defaultdict(list)
    for key, cells in panel.items():
        for w, c in cells.items():
            weekly[key[side], w].append(Fraction(c, 100))
    by_group = defaultdict(dict)
    for (g, w), values in weekly.items():
        by_group[g][w] = mean(values)
    return {(g, w): mean([m for v, m in weeks.items() if v < w]) for g, weeks in by_group.items() for w in weeks}, by_group


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_all_features(spark, seed):
    panel = draw(seed, 70)
    got = {(r["store"], r["dept"], r["date"]): r for r in FE.build_all_features(frame(spark, panel), REFERENCE_HOLIDAYS).collect()}
    assert len(got) == sum(map(len, panel.values()))
    by_store, _ = earlier_means(panel, 0)
    by_dept, _ = earlier_means(panel, 1)
    days = [dt.date.fromisoformat(x) for _, x in REFERENCE_HOLIDAYS]
    for (s, d), cells in panel.items():
        line = sorted(cells)
        for at, w in enumerate(line):
            r, past = got[s, d, day(w)], [Fraction(cells[v], 100) for v in line[:at]]
            for k in (1, 2, 4, 52):
                assert close(r[f"sales_lag_{k}"], past[-k] if at >= k else None)
            for k in (4, 8):
                last = past[-k:]
                assert close(r[f"sales_rolling_mean_{k}"], mean(last))
                spread = math.sqrt(sum((x - mean(last)) ** 2 for x in last) / (len(last) - 1)) if len(last) > 1 else None
                assert close(r[f"sales_rolling_std_{k}"], spread)
            gap = min(abs((x - day(w)).days) for x in days)
            assert r["days_to_nearest_holiday"] == next((x - day(w)).days for x in days if abs((x - day(w)).days) == gap)
            assert close(r["dept_avg_sales_expanding"], by_dept[d, w])
            assert close(r["store_avg_sales_expanding"], by_store[s, w])


@pytest.mark.parametrize("seed", [3, 4])
def test_prior_year_and_frozen(spark, seed):
    panel = draw(seed, 130)
    df = frame(spark, panel)
    for r in FE.add_prior_year_sales(df).collect():
        week = r["date"].isocalendar().week
        same = [c for w, c in panel[r["store"], r["dept"]].items() if day(w).year == r["date"].year - 1 and day(w).isocalendar().week == week]
        assert close(r["sales_lag_52wk"], Fraction(same[0], 100) if same else None)
    _, weekly = earlier_means(panel, 1)
    for r in FZ.frozen_group_average(df, "dept").collect():
        weeks = sorted(weekly[r["dept"]])
        used = weeks[:-1] or weeks
        assert close(r["dept_avg_sales_expanding"], mean([weekly[r["dept"]][w] for w in used]))


def test_merge_keeps_rows_without_key(spark):
    sales = spark.createDataFrame([(1, 1, day(0), 5.0, False), (None, 1, day(0), 6.0, False), (1, 1, None, 7.0, True)],
                                  "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    features = spark.createDataFrame([(1, day(0), 3.5, False)], "store int, date date, temperature double, is_holiday boolean")
    stores = spark.createDataFrame([(1, "A", 10)], "store int, type string, size int")
    got = {r["weekly_sales"]: (r["temperature"], r["type"]) for r in P.merge_all(sales, features, stores).collect()}
    assert got == {5.0: (3.5, "A"), 6.0: (None, None), 7.0: (None, "A")}


def test_series_whose_folds_all_failed_stays(spark):
    from panelcast.plans.q_models import _score_by_series
    pred = spark.createDataFrame([(1, 1, 0, 10.0, 12.0, False, None), (1, 2, 0, 10.0, None, False, "no fit"), (1, 2, 1, 10.0, None, False, "no fit")],
                                 "store int, dept int, fold int, y double, y_pred double, is_holiday boolean, error string")
    got = {r["dept"]: (r["wmae"], r["n_folds"]) for r in _score_by_series(pred, "ar").collect()}
    assert got == {1: (2.0, 1), 2: (None, 0)}


def test_every_named_holiday_is_set(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from panelcast.plans.q_core import PANEL_HOLIDAYS
    names = sorted({n for n, _ in PANEL_HOLIDAYS})
    table = E.queries()["feature_table_all"](spark, SF_SMALL)
    flags = [c for c in table.columns if any(c.endswith(n) or n in c for n in names)]
    assert len(flags) == len(names)
    sums = table.agg(*[F.sum(F.col(c).cast("int")).alias(c) for c in flags], F.max(F.abs("days_to_nearest_holiday")).alias("far")).first()
    assert all(sums[c] > 0 for c in flags) and sums["far"] < 200


def test_quantiles_refuse_infinity(spark):
    from panelcast.functions.quantiles import exact_quantiles
    with pytest.raises(ValueError, match="finite"):
        exact_quantiles(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), "x", [0.5])


def test_more_categories_than_the_default_bins(spark):
    from panelcast.models import trees as T
    rows = [(k, float(k % 7), float(10 * (k % 7)) + i) for k in range(200) for i in range(3)]
    df = spark.createDataFrame(rows, "dept int, x double, weekly_sales double")
    assert T.category_bins(df, ["dept", "x"]) == 202
    model = T.tree_pipeline(["dept", "x"], {**T.PRESET_QUICK, "maxIter": 2}, max_bins=T.category_bins(df, ["dept", "x"])).fit(df)
    assert model.transform(df).count() == 600
