"""Run a query and its SQL side by side and describe every difference."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if value is None:
        return "~"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, fn, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, folder)
    ours, our_cols = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    sql_cols = [d[0] for d in rel.description]
    theirs, their_cols = _rows(sql_cols, rel.fetchall())
    if our_cols != their_cols:
        return f"{name}: columns {our_cols} != {their_cols}"
    if not ours:
        return f"{name}: no rows"
    if ours != theirs:
        extra, lacking = _difference(ours, theirs), _difference(theirs, ours)
        return (
            f"{name}: rows {len(ours)} vs {len(theirs)}; only ours {len(extra)} {extra[:3]}; "
            f"only sql {len(lacking)} {lacking[:3]}"
        )
    return None


def _difference(a, b):
    from collections import Counter

    return list((Counter(a) - Counter(b)).elements())


def timed(fn, *args):
    start = time.time()
    result = fn(*args)
    return result, time.time() - start
