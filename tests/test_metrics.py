"""D12 golden values (hand-computed from the formula) and T11 edge cases."""

import pytest
from pyspark.sql import functions as F

from panelcast.functions.metrics import compare_models, wmae_expr


def _wmae(spark, rows):
    df = spark.createDataFrame(rows, "y double, y_pred double, is_holiday boolean")
    return df.agg(wmae_expr().alias("w")).first()["w"]


@pytest.mark.parametrize("pred, expected", [
    ((90, 210, 60), 10.0),
    ((80, 200, 50), 100 / 7),
    ((100, 200, 30), 20 / 7),
])
def test_wmae_golden(spark, pred, expected):
    rows = [(100.0, float(pred[0]), True), (200.0, float(pred[1]), False), (50.0, float(pred[2]), False)]
    assert _wmae(spark, rows) == pytest.approx(expected, abs=1e-12)


def test_wmae_null_prediction_propagates(spark):
    assert _wmae(spark, [(1.0, None, False), (2.0, 2.0, False)]) is None


def test_wmae_null_flag_counts_as_holiday(spark):
    # T11
    # |1-0|*5 + |2-2|*1 over 6
    assert _wmae(spark, [(1.0, 0.0, None), (2.0, 2.0, False)]) == pytest.approx(5 / 6)


def test_wmae_negative_target(spark):
    assert _wmae(spark, [(-10.0, 0.0, False)]) == pytest.approx(10.0)


def test_compare_models_zero_baseline(spark):
    s = spark.createDataFrame([(1, "a", 0.0), (1, "b", 1.0)], "k int, model string, wmae double")
    r = compare_models(s, "k", "model", "wmae", "a", "b").first()
    assert r["improvement_pct"] is None
