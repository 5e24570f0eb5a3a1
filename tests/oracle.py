"""Run a named query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    return sorted(map(tuple, frame.itertuples(index=False)), key=repr)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    kinds = lambda f: {c: f[c].dtype.kind + str(f[c].dtype.itemsize) for c in f.columns}
    if kinds(spark_frame) != kinds(sql_frame):
        return f"types {kinds(spark_frame)} vs {kinds(sql_frame)}"
    left, right = _comparable(spark_frame), _comparable(sql_frame)
    if left != right:
        odd = [pair for pair in zip(left, right) if pair[0] != pair[1]][:2]
        return f"{len(left)} vs {len(right)} rows; {odd}"
    return ""
