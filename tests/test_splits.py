"""J1 walk-forward folds (T10) on the reference calendar."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators import splits as SP


def _fridays(spark, start, n):
    d0 = dt.date.fromisoformat(start)
    return spark.createDataFrame([(d0 + dt.timedelta(days=7 * i),) for i in range(n)], "date date")


def test_walk_forward_reference_dates(spark):
    df = _fridays(spark, "2010-02-05", 143)
    folds = SP.walk_forward_folds(df, n_splits=3, horizon_weeks=38).orderBy("fold").collect()
    got = [(r["fold"], r["val_start"].isoformat(), r["val_end"].isoformat()) for r in folds]
    assert got == [(0, "2010-08-20", "2011-05-13"), (1, "2011-05-13", "2012-02-03"), (2, "2012-02-03", "2012-10-26")]
    summ = SP.fold_summary(SP.assign_folds(df, SP.walk_forward_folds(df))).orderBy("fold").collect()
    assert [r["n_train"] for r in summ] == [28, 66, 104]
    assert [r["n_val_dates"] for r in summ] == [39, 39, 39]


def test_fold_with_empty_train_is_omitted(spark):
    df = _fridays(spark, "2010-02-05", 50)
    folds = SP.walk_forward_folds(df, n_splits=3, horizon_weeks=38).collect()
    assert len(folds) == 1 and folds[0]["fold"] == 0


def test_per_series_fold_guard(spark):
    rows = [(1, 1, dt.date(2010, 2, 5) + dt.timedelta(days=7 * i)) for i in range(60)]
    rows += [(1, 2, dt.date(2010, 2, 5) + dt.timedelta(days=7 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "store int, dept int, date date")
    f = SP.per_series_folds(df, n_splits=3, horizon_weeks=13, min_train=30)
    assert set(f.select("dept").distinct().toPandas()["dept"]) == {1}
    assert f.filter(F.col("n_train") < 30).count() == 0
