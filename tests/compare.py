"""Compares a DataFrame with a DuckDB result, whatever the order of rows and columns."""

import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in os.listdir(sf):
        c.execute(f"create view {t.split('.')[0]} as select * from read_parquet('{sf}/{t}')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(df, con, sql: str) -> None:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())
