"""Registry of named queries: each is a Spark plan over the driver tables
plus, where SQL can express it, the equivalent DuckDB SQL (the oracle).

Every query reads whole tables; floats are rounded to 4 decimals in both
engines so order-dependent double sums compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Operator IDs each query exercises, for the coverage table.
COVERS: dict[str, list[str]] = {}


def half_up_sql(sql: str, digits: int = 4) -> str:
    """Rewrite ``ROUND(e, 4)`` as ``floor((e) * 1e4 + 0.5) / 1e4`` in oracle SQL.

    Both engines then round the identical double with identical IEEE steps
    (their ROUND functions disagree on exact decimal ties).
    """
    key, out, i = "ROUND(", [], 0
    tail = f", {digits})"
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        if inner.endswith(tail[:-1]):
            e = half_up_sql(inner[: -len(tail) + 1], digits)
            out.append(f"(floor(({e}) * {10 ** digits} + 0.5) / {10 ** digits})")
        else:
            out.append(key + half_up_sql(inner, digits) + ")")
        i = k


def register(name: str, sql: str | None = None, covers: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = half_up_sql(sql)
        COVERS[name] = covers.split()
        return fn
    return deco


def r4(c: Column | str, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    # half-up on the binary value, same IEEE steps as the oracle's rewrite
    out = F.floor(col * 10000 + 0.5) / 10000
    alias = name or (c if isinstance(c, str) else None)
    return out.alias(alias) if alias else out


def r4_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select([r4(c) if c in cols else F.col(c) for c in df.columns])


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_core, q_audit, q_series, q_eval, q_models, q_sources, q_joins  # noqa: F401
