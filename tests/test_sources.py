"""A1 CSV reader round trip, A3/A5 sinks, derived test panel invariants."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from panelcast.sources import readers as R
from panelcast.sources import sinks as SK
from panelcast.sources import testpanel as TP

from conftest import SF_SMALL


def test_load_raw_data_csv(spark):
    d = tempfile.mkdtemp(prefix="pc-csv-")
    files = {
        "train.csv": "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,24924.5,False\n1,1,2010-02-12,-46.0,True\n",
        "test.csv": "Store,Dept,Date,IsHoliday\n1,1,2012-11-02,False\n",
        "features.csv": "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,"
                        "Unemployment,IsHoliday\n1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.09,8.106,False\n",
        "stores.csv": "Store,Type,Size\n1,A,151315\n",
    }
    for k, v in files.items():
        with open(os.path.join(d, k), "w") as f:
            f.write(v)
    train, test, feats, stores = R.load_raw_data(spark, d)
    assert train.columns == ["store", "dept", "date", "weekly_sales", "is_holiday"]
    assert train.filter("weekly_sales < 0").count() == 1
    assert feats.filter(F.col("markdown1").isNull()).count() == 1
    assert test.first()["date"] == dt.date(2012, 11, 2)
    assert stores.first()["size"] == 151315


def test_forecast_sink_and_run_log(spark):
    d = tempfile.mkdtemp(prefix="pc-sink-")
    df = spark.createDataFrame([("1_1_2012-11-02", 1.5)], "Id string, Weekly_Sales double")
    SK.write_forecast(df, os.path.join(d, "sub"))
    back = spark.read.option("header", True).csv(os.path.join(d, "sub"))
    assert back.columns == ["Id", "Weekly_Sales"] and back.count() == 1
    log = os.path.join(d, "log")
    SK.log_metrics(spark, log, "r1", "metric", {"wmae": 2.0})
    SK.log_metrics(spark, log, "r2", "metric", {"wmae": 3.0})
    s = {r["run"]: r["wmae"] for r in SK.run_summary(spark, log).collect()}
    assert s == {"r1": 2.0, "r2": 3.0}


def test_test_panel_invariants(spark):
    p = TP.sales_panel(spark, SF_SMALL, "nation")
    from panelcast.sources.schemas import duplicate_keys
    assert duplicate_keys(p).count() == 0
    assert p.filter(F.dayofweek("date") != 6).count() == 0  # all Fridays
    train, test = TP.train_test_split(p)
    assert train.count() + test.count() == p.count() - p.filter(
        (F.col("store") == 0) & (F.col("dept") == 1) & (F.col("date") <= test.agg(F.min("date")).first()[0])).count()
    assert "weekly_sales" not in test.columns
