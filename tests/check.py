"""Compare registered queries with their oracle SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def differences(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    mine = normal(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = normal(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(mine) != len(theirs):
        extra = sorted(set(mine) - set(theirs), key=str)[:2], sorted(set(theirs) - set(mine), key=str)[:2]
        return f"rows {len(mine)} vs {len(theirs)}; only mine / only theirs {extra}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(columns)}\n mine   {a}\n theirs {b}"
    return None
