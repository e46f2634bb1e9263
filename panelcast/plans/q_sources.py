"""Queries that read back what the sinks and the CSV layout wrote, audits per source table, and the additive design."""

from __future__ import annotations

import functools
import math

from pyspark.sql import functions as F

from ..functions.calendar import holiday_frame
from ..models import additive as AD
from ..operators import prep as P
from ..sources import sinks as SK
from ..sources.readers import load_raw_data
from . import sqlparts as Q
from .catalog import ORACLE, QUERIES, r4, r4_cols, register
from .q_core import FEAT_COLS, PANEL_HOLIDAYS, PANEL_SQL, lazy_panel
from . import q_eval  # noqa: F401  the submission queries
from .q_models import shared_path, write_reference_layout

_SOURCE_SQL = Q.with_(Q.panel_cte("nation"), Q.split_ctes(unseen=False), Q.features_cte("nation"), Q.stores_cte("nation"))
_TABLES = {
    "train": ["store", "dept", "date", "weekly_sales", "is_holiday"],
    "test": ["store", "dept", "date", "is_holiday"],
    "features": ["store", "date", *FEAT_COLS, "is_holiday"],
    "stores": ["store", "type", "size"],
}


def _raw(spark, sf):
    path = shared_path(spark, "csv")
    write_reference_layout(spark, sf, path)
    return dict(zip(_TABLES, load_raw_data(spark, path)))


@register("csv_test_roundtrip", _SOURCE_SQL + "SELECT " + ", ".join(_TABLES["test"]) + " FROM test", covers="A1 H1")
def q_csv_test(spark, sf):
    return _raw(spark, sf)["test"]


@register("csv_features_roundtrip", _SOURCE_SQL + "SELECT store, date, is_holiday, " + ", ".join(f"ROUND({c}, 4) AS {c}" for c in FEAT_COLS) + " FROM features",
          covers="A1 H1")
def q_csv_features(spark, sf):
    return r4_cols(_raw(spark, sf)["features"], FEAT_COLS)


@register("csv_stores_roundtrip", _SOURCE_SQL + "SELECT store, type, size FROM stores", covers="A1")
def q_csv_stores(spark, sf):
    return _raw(spark, sf)["stores"]


@register("source_null_audit", _SOURCE_SQL + " UNION ALL ".join(
    f"SELECT '{t}' AS source, '{c}' AS column, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {t}"
    for t, cols in _TABLES.items() for c in cols), covers="D5 D6 A1")
def q_source_null_audit(spark, sf):
    """Rows and NULLs of every column of the four CSV tables."""
    parts = []
    for name, df in _raw(spark, sf).items():
        rows = df.agg(F.count(F.lit(1))).scalar()
        parts.append(P.null_counts(df).select(F.lit(name).alias("source"), "column", rows.alias("n_rows"), "n_null"))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@register("submission_csv", ORACLE["submission"], covers="A3 H5")
def q_submission_csv(spark, sf):
    path = shared_path(spark, "submission")
    SK.write_forecast(QUERIES["submission"](spark, sf), path)
    return spark.read.option("header", True).schema("Id string, Weekly_Sales double").csv(path)


def _design_sql(order: int = 10) -> str:
    days = "CAST(date - DATE '1970-01-01' AS DOUBLE)"
    terms = [f"ROUND({days} / 365.25, 4) AS t"]
    for k in range(1, order + 1):
        angle = f"{days} * {2 * math.pi * k / 365.25!r}"
        terms += [f"ROUND(sin({angle}), 4) AS sin{k}", f"ROUND(cos({angle}), 4) AS cos{k}"]
    for name in sorted({n for n, _ in PANEL_HOLIDAYS}):
        days_of = ", ".join(f"DATE '{d}'" for n, d in PANEL_HOLIDAYS if n == name)
        for off in range(-7, 1):
            label = f"hol_{name}_{str(off).replace('-', 'm')}"
            terms.append(f"CASE WHEN date - CAST({off} AS INTEGER) IN ({days_of}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {label}")
    return PANEL_SQL + "SELECT store, dept, date, " + ", ".join(terms) + " FROM panel"


@register("additive_design", _design_sql(), covers="K21 H17")
def q_additive_design(spark, sf):
    """Time, yearly Fourier pairs and holiday-window dummies of every panel row."""
    d, names = AD.design(lazy_panel(spark, sf), holiday_frame(spark, PANEL_HOLIDAYS))
    return d.select("store", "dept", "date", r4("t"), *[F.col(c) if c.startswith("hol_") else r4(c) for c in names])
