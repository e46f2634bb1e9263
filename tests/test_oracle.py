"""Every query with oracle SQL matches DuckDB exactly on the smallest driver tables;
rows-only queries run and return rows."""

import datetime as dt

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from panelcast.plans import catalog

TABLES = "region nation customer supplier part orders lineitem".split()
catalog.load_all()
QUERIES, SQL = dict(catalog.QUERIES), dict(catalog.ORACLE)
HEAVY = {"gbt_walk_forward_cv", "gbt_feature_importance", "gbt_pipeline_newest_fold", "gbt_random_search",
         "gbt_forecast_saved_model", "gbt_leafwise_preset_cv", "gbt_histogram_preset_cv", "gbt_patience_path", "features_by_importance", "dlinear_validation_wmae", "dlinear_forecast_submission"}


def _norm(v):
    if isinstance(v, pd.Timestamp):
        return v.date()
    if v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


CANON_SPARK = {"IntegerType()": "int", "LongType()": "bigint", "DoubleType()": "double", "DateType()": "date",
               "BooleanType()": "bool", "StringType()": "string"}
CANON_DUCK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "bool",
              "VARCHAR": "string"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    st = {f.name: CANON_SPARK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    dt = {r[0]: CANON_DUCK.get(str(r[1]), str(r[1])) for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert st == dt
    s = sdf.toPandas()
    d = con.execute(SQL[name]).df()
    sc, sr = _rows(s)
    dc, dr = _rows(d)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - HEAVY))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_lists_all_of_them():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["fold", "val_start", "val_end", "n_val", "n_scored", "n_dropped", "wmae"]
    assert df.count() > 0
