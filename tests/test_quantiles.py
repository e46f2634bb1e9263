"""Distributed exact quantiles vs numpy (linear interpolation), including heavy
duplicates and refinement passes forced by a tiny bracket limit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 2.5), rng.integers(0, 100, 1000).astype(float)])
    g = np.repeat([0, 1], 3000)
    return vals, g, spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, vals)], "g int, x double")


@pytest.mark.parametrize("kw", [dict(bins=8), dict()])
def test_global(spark, data, kw):
    vals, _, df = data
    q = exact_quantiles(df, "x", PROBS, **kw).toPandas().sort_values("prob")
    assert np.allclose(q["value"].to_numpy(), np.quantile(vals, PROBS), rtol=0, atol=1e-12)


@pytest.mark.parametrize("kw", [dict(bins=8), dict()])
def test_grouped(spark, data, kw):
    vals, g, df = data
    q = exact_quantiles(df, "x", [0.5, 0.9], by=["g"], **kw).toPandas().sort_values(["g", "prob"])
    ref = np.concatenate([np.quantile(vals[g == k], [0.5, 0.9]) for k in (0, 1)])
    assert np.allclose(q["value"].to_numpy(), ref, atol=1e-12)


def test_nulls_ignored_and_single_value(spark):
    df = spark.createDataFrame([(None,), (3.0,), (3.0,)], "x double")
    q = exact_quantiles(df, "x", [0.5], bins=16).first()["value"]
    assert q == 3.0
