"""Runs a query and its SQL over the same tables and compares names, row counts and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else 0.0 if x == 0 else x
    if isinstance(x, (list, tuple)):
        return [value(y) for y in x]
    return x


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(([value(r[k]) for k in order] for r in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    want = con.sql(sql)
    if sorted(df.columns) != sorted(want.columns):
        return [f"columns {sorted(df.columns)} != {sorted(want.columns)}"]
    a, b = rows_of(df.columns, df.collect()), rows_of(want.columns, want.fetchall())
    found = [f"rows {len(a)} != {len(b)}"] if len(a) != len(b) else []
    return found + [f"{x} != {y}" for x, y in zip(a, b) if repr(x) != repr(y)][:3]
