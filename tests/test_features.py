"""Window features and preparation on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import features as FE
from panelcast.operators import fallback as FB
from panelcast.operators import frozen as FZ
from panelcast.operators import prep as P

D0 = dt.date(2010, 2, 5)


def _d(i):
    return D0 + dt.timedelta(days=7 * i)


def _panel(spark, rows):
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean")


def test_lag_is_row_based_across_gaps(spark):
    df = _panel(spark, [(1, 1, _d(0), 1.0, False), (1, 1, _d(2), 2.0, False), (1, 1, _d(3), 3.0, False)])
    out = FE.add_lag_features(df, lags=(1,)).orderBy("date").collect()
    assert [r["sales_lag_1"] for r in out] == [None, 1.0, 2.0]


def test_rolling_uses_previous_rows_and_sample_std(spark):
    # T2 (previous w rows, min one value) and T3 (sample std: one value -> NULL)
    df = _panel(spark, [(1, 1, _d(i), float(v), False) for i, v in enumerate([10, 20, 40])])
    out = FE.add_rolling_features(df, windows=(4,)).orderBy("date").collect()
    assert out[0]["sales_rolling_mean_4"] is None
    assert out[1]["sales_rolling_mean_4"] == 10.0 and out[1]["sales_rolling_std_4"] is None
    assert out[2]["sales_rolling_std_4"] == pytest.approx(7.0710678118654755)


def test_rolling_exact_matches_float(spark):
    df = _panel(spark, [(1, 1, _d(i), float(v), False) for i, v in enumerate([1005, 2010, 4023, 777, 9])])
    df = df.withColumn("cents", F.col("weekly_sales").cast("bigint"))
    a = df.select("date", *FE.rolling_exact_columns((4,), "cents", scale=1.0)).orderBy("date").collect()
    b = FE.add_rolling_features(df, windows=(4,)).orderBy("date").collect()
    for x, y in zip(a, b):
        for c in ("sales_rolling_mean_4", "sales_rolling_std_4"):
            assert (x[c] is None and y[c] is None) or x[c] == pytest.approx(y[c])


def test_expanding_dept_avg_mean_of_means_excluding_current(spark):
    df = _panel(spark, [(1, 1, _d(0), 10.0, False), (2, 1, _d(0), 30.0, False),
                        (1, 1, _d(1), 50.0, False), (1, 1, _d(2), 0.0, False)])
    out = {(r["store"], r["date"]): r["dept_avg_sales_expanding"] for r in FE.add_expanding_dept_avg(df).collect()}
    assert out[(1, _d(0))] is None
    assert out[(1, _d(1))] == 20.0          # mean of per-date mean 20
    assert out[(1, _d(2))] == 35.0          # mean of 20 and 50


def test_frozen_average_excludes_last_date(spark):
    df = _panel(spark, [(1, 7, _d(0), 10.0, False), (1, 7, _d(1), 20.0, False), (1, 7, _d(2), 90.0, False),
                        (1, 8, _d(0), 5.0, False)])
    got = {r["dept"]: r["dept_avg_sales_expanding"] for r in FZ.frozen_group_average(df, "dept").collect()}
    assert got == {7: 15.0, 8: 5.0}


def test_prior_year_duplicate_key_does_not_fan_out(spark):
    rows = [(1, 1, dt.date(2010, 3, 1), 10.0, False), (1, 1, dt.date(2010, 3, 2), 30.0, False),
            (1, 1, dt.date(2011, 3, 1), 5.0, False)]
    df = _panel(spark, rows)
    out = FE.add_prior_year_sales(df)
    assert out.count() == 3
    r = out.filter(F.year("date") == 2011).first()
    assert r["sales_lag_52wk"] == 20.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (3.0,)], "p double")
    assert [r[0] for r in df.select(FB.clip_lower("p")).collect()] == [0.0, None, 3.0]


def test_ffill_leading_null_stays_null_and_fill_zero(spark):
    rows = [(1, 1, _d(0), 1.0, False, None, None), (1, 1, _d(1), 1.0, False, 2.0, None),
            (1, 1, _d(2), 1.0, False, None, None)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean, "
                                     "cpi double, markdown1 double")
    out = P.clean_data(df, zero_cols=["markdown1"], ffill_cols=("cpi",)).orderBy("date").collect()
    assert [r["cpi"] for r in out] == [None, 2.0, 2.0]
    assert [r["markdown1"] for r in out] == [0.0, 0.0, 0.0]


def test_ffill_row_order_parity(spark):
    # Reference order (dept, date) inside a store carries dept 1's last value into dept 2
    rows = [(1, 1, _d(0), 1.0, False, 1.0), (1, 1, _d(1), 1.0, False, 5.0),
            (1, 2, _d(0), 1.0, False, None)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean, "
                                     "cpi double")
    lit = P.clean_data(df, zero_cols=[], ffill_cols=("cpi",), order_by="dept")
    assert lit.filter("dept = 2").first()["cpi"] == 5.0


def test_merge_keeps_rows_and_drops_duplicate_flag(spark):
    sales = _panel(spark, [(1, 1, _d(0), 1.0, True), (2, 1, _d(0), 2.0, False)])
    feat = spark.createDataFrame([(1, _d(0), 3.0, False)], "store int, date date, cpi double, is_holiday boolean")
    stores = spark.createDataFrame([(1, "A", 100)], "store int, type string, size int")
    m = P.merge_all(sales, feat, stores)
    assert m.count() == 2
    assert m.filter("store = 1").first()["is_holiday"] is True
    assert m.filter("store = 2").first()["cpi"] is None


def test_nan_is_turned_into_null(spark):
    from panelcast.sources.schemas import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert nan_to_null(df).filter(F.col("x").isNull()).count() == 1
