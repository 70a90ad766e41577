"""Compares a query's rows with those of its SQL in DuckDB."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def _cell(x) -> str:
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return "null"
    if isinstance(x, float):
        return f"{x:.6g}"
    return str(x.tolist()) if hasattr(x, "tolist") else str(x)


def rows_of(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_cell, r)) for r in frame.itertuples(index=False))


def check(spark, build, sql: str, sf_dir: str = SF) -> None:
    got, want = build(spark, sf_dir).toPandas(), connect(sf_dir).execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
