"""One prediction per test row, cascade branches, T20 step mapping."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators import fallback as FB

D0 = dt.date(2010, 2, 5)


def _d(i):
    return D0 + dt.timedelta(days=7 * i)


def test_cascade_branches(spark):
    hist = [(1, 1, _d(i), 100.0) for i in range(60)] + [(1, 2, _d(i), 10.0) for i in range(5)]
    history = spark.createDataFrame(hist, "store int, dept int, date date, weekly_sales double")
    test = spark.createDataFrame([(s, d, _d(60 + k)) for s, d in [(1, 1), (1, 2), (9, 9)] for k in range(3)],
                                 "store int, dept int, date date")
    model = spark.createDataFrame([(1, 1, k, -5.0 + k) for k in range(3)], "store int, dept int, step int, y_model double")
    out = FB.fallback_cascade(test, history, model).orderBy("store", "dept", "date").collect()
    assert len(out) == 9
    src = {(r["store"], r["dept"]): r["source"] for r in out}
    assert src == {(1, 1): "model", (1, 2): "series_mean", (9, 9): "global_mean"}
    m = [r["y_pred"] for r in out if r["dept"] == 1 and r["store"] == 1]
    assert m == [0.0, 0.0, 0.0]  # -5, -4, -3 clipped
    g = [r["y_pred"] for r in out if r["store"] == 9][0]
    assert abs(g - (60 * 100 + 5 * 10) / 65) < 1e-9


def test_lookup_default_and_missing_count(spark):
    test = spark.createDataFrame([(1, 1, _d(0)), (2, 2, _d(0))], "store int, dept int, date date")
    preds = spark.createDataFrame([(1, 1, _d(0), 7.0)], "store int, dept int, date date, y_pred double")
    out = FB.lookup_predictions(test, preds)
    assert out.count() == 2 and out.filter("is_missing").count() == 1
    assert out.filter("store = 2").first()["y_pred"] == 0.0


def test_submission_id_format(spark):
    df = spark.createDataFrame([(1, 2, dt.date(2012, 11, 2), 3.5)], "store int, dept int, date date, y_pred double")
    assert FB.submission_frame(df).first()["Id"] == "1_2_2012-11-02"
