"""Compares registered queries with their SQL on DuckDB over the driver's smallest tables."""

import glob
import os

import duckdb
import pandas as pd

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def canonical(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].map(lambda x: None if pd.isna(x) else float(f"{x:.9g}"))
        df[c] = df[c].map(lambda x: "null" if x is None or (isinstance(x, float) and pd.isna(x)) else str(x))
    return list(df.columns), sorted(map(tuple, df.values.tolist()))


def same(spark, con, run, sql):
    return canonical(run(spark, DATA).toPandas()) == canonical(con.sql(sql).df())
