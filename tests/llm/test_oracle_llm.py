"""Queries with SQL agree with DuckDB on the driver's tables."""

import pytest

import panelcast.llm
from conftest import SF_SMALL
from llm.llm_tools import duck, rows

REGISTRY = panelcast.llm.load_queries()


@pytest.mark.parametrize("folder", [SF_SMALL, "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(REGISTRY.ORACLE))
def test_query_matches_sql(spark, name, folder):
    got, want = REGISTRY.QUERIES[name](spark, folder).toPandas(), duck(REGISTRY.ORACLE[name], folder)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_query_names():
    names = {n.split("_")[0] for n in REGISTRY.QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
