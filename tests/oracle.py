"""Runs a query and its SQL and compares the results as sets of rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return ("f", float(f"{v:.12g}"))
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((repr([_plain(r[i]) for i in order]) for r in rows))


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), rows_of(names, cur.fetchall())
