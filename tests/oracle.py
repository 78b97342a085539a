"""Compare a query with its DuckDB text, as sets of rows."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def _cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, (list, dict)):
        return str(x)
    if x is None or pd.isna(x):
        return "null"
    if isinstance(x, float):
        return f"{x:.6g}" if x != int(x) else str(int(x))
    return str(x)


def rows(df):
    return sorted("|".join(_cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


def assert_same(spark_df, con, sql):
    a, b = spark_df.toPandas(), con.sql(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
