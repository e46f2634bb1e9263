"""Helpers of the text operators' tests."""

import os

import duckdb
import pandas as pd


def duck(sql, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            path = f"{folder}/{f}"
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con.execute(sql).df()


def rows(df):
    """Sorted rows with columns by name; dates and missing values made comparable."""
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "date") and not isinstance(v, str):
            return str(v)[:10]
        if type(v).__name__ == "date":
            return str(v)
        return v.item() if hasattr(v, "item") else v
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None)), key=repr)
