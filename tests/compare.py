"""Holds a query's rows against those of its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, (int, float)) or type(v).__module__ == "numpy":
        return f"{float(v):.6f}"
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(tuple(_norm(v) for v in r) for r in df[names].astype(object).itertuples(index=False))


def oracle(sql: str, sf_dir: str = DATA) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = Path(f"{sf_dir}/{t}.parquet")
        con.execute(f"create view {t} as select * from read_parquet('{p / '*.parquet' if p.is_dir() else p}')")
    return con.sql(sql).df()


def assert_same(spark, query, sql: str, sf_dir: str = DATA) -> None:
    got, want = query(spark, sf_dir).toPandas(), oracle(sql, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
