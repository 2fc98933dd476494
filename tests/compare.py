"""Comparison of a query's rows with its SQL twin, run by DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def tables(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(v)
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


def differences(con, df, sql):
    """Empty if both sides hold the same columns and the same bag of rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = bag(names, expected.fetchall())
    ours = bag(df.columns, df.collect())
    if ours == theirs:
        return "" if ours else "no rows"
    more, less = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows vs {sum(theirs.values())}; only ours {sum(more.values())}: "
            f"{list(more)[:3]}; only SQL {sum(less.values())}: {list(less)[:3]}")


def types(con, df, sql):
    """Column types of both sides, for a look by eye."""
    described = con.execute(f"describe {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    return {c: (t, theirs.get(c)) for c, t in df.dtypes}
