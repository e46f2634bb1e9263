"""T13, T14/T15 and T21 on literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.models import trees as T
from panelcast.operators import features as FE
from panelcast.operators import prep as P

D0 = dt.date(2010, 2, 5)


def _d(i):
    return D0 + dt.timedelta(days=7 * i)


def test_fill_sees_only_the_frame_passed_in(spark):
    # The validation slice starts with NULL cpi; it must not borrow the last train value
    rows = [(1, 1, _d(i), 1.0, False, (5.0 if i < 3 else None)) for i in range(6)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double, is_holiday boolean, "
                                     "cpi double")
    val = df.filter(F.col("date") >= F.lit(_d(3)))
    out = P.clean_data(val, zero_cols=[], ffill_cols=("cpi",)).collect()
    assert all(r["cpi"] is None for r in out)
    full = P.clean_data(df, zero_cols=[], ffill_cols=("cpi",)).filter(F.col("date") >= F.lit(_d(3))).collect()
    assert all(r["cpi"] == 5.0 for r in full)


def test_null_keys_do_not_match_or_group(spark):
    # NULL store never joins; T15: NULL dept is not a group of the expanding mean
    sales = spark.createDataFrame([(None, 1, _d(0), 1.0, False), (1, None, _d(0), 2.0, False), (1, 1, _d(0), 3.0, False)],
                                  "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    feats = spark.createDataFrame([(None, _d(0), 9.0)], "store int, date date, cpi double")
    stores = spark.createDataFrame([(1, "A", 1)], "store int, type string, size int")
    m = P.merge_all(sales, feats, stores)
    assert m.filter(F.col("cpi").isNotNull()).count() == 0
    e = FE.add_expanding_dept_avg(sales)
    assert e.count() == 3


def test_unseen_category_gets_extra_index(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 2.0)], "store int, x double")
    test = spark.createDataFrame([(3, 1.0)], "store int, x double")
    stages = T.encoding_stages(["store", "x"])
    pre, idx = stages[0], stages[1]
    model = idx.fit(pre.transform(train))
    got = model.transform(pre.transform(test)).first()["store__idx"]
    assert got == 2.0  # two train labels -> indices 0, 1; unseen -> 2
