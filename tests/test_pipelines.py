"""End-to-end flows on the smallest driver tables: every test row gets one prediction."""

from pyspark.sql import functions as F

from panelcast.functions.calendar import derived_holidays, holiday_frame
from panelcast.models import trees as T
from panelcast.plans import pipelines as PL
from panelcast.plans.q_core import PANEL_HOLIDAYS
from panelcast.sources import testpanel as TP

from conftest import SF_SMALL


def _data(spark):
    p = TP.sales_panel(spark, SF_SMALL, "region")
    train, test = TP.train_test_split(p)
    return p, train, test


def test_tree_flow(spark):
    p, train, test = _data(spark)
    r = PL.tree_flow(train, test, TP.features_table(spark, SF_SMALL, "region"),
                     TP.stores_table(spark, SF_SMALL, "region"), PANEL_HOLIDAYS, params={**T.PRESET_QUICK, "maxIter": 5})
    assert r.fold_scores.count() >= 1
    assert r.submission.count() == test.count()
    assert r.submission.filter(F.col("Weekly_Sales") < 0).count() == 0


def test_window_flow(spark):
    p, train, test = _data(spark)
    r = PL.window_flow(train, test)
    assert r.submission.count() == test.count()
    assert r.submission.select("Id").distinct().count() == test.count()


def test_per_series_flow(spark):
    p, _, _ = _data(spark)
    out = PL.per_series_flow(p, holiday_frame(spark, derived_holidays(1994, 2002)))
    assert out.count() > 0 and set(out.columns) >= {"sar", "additive", "improvement_pct"}


def test_readme_example_from_csv(spark):
    """The README flow: reference-layout CSVs -> load_raw_data -> tree_flow."""
    from panelcast.plans.q_models import shared_path, write_reference_layout
    from panelcast.sources.readers import load_raw_data
    path = shared_path(spark, "readme")
    write_reference_layout(spark, SF_SMALL, path)
    train, test, features, stores = load_raw_data(spark, path)
    r = PL.tree_flow(train, test, features, stores, PANEL_HOLIDAYS, params={**T.PRESET_QUICK, "maxIter": 3})
    assert r.submission.count() == test.count()
    assert r.fold_scores.filter(F.col("wmae").isNull()).count() == 0
