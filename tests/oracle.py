"""Compare a query with its SQL twin on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _kind(v):
    return {bool: "bool", int: "int", float: "float", str: "str"}.get(type(v), type(v).__name__)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short reason."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wide = [n for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]
    if wide:
        return f"cast these in SQL: {[(n, types[n]) for n in wide]}"
    order = sorted(names)
    gi, wi = [df.columns.index(n) for n in order], [names.index(n) for n in order]
    a = sorted((tuple(_plain(r[i]) for i in gi) for r in got), key=repr)
    b = sorted((tuple(_plain(r[i]) for i in wi) for r in want), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; spark {a[:2]} sql {b[:2]}"
    for n, i in zip(order, range(len(order))):
        ka = {_kind(r[i]) for r in a if r[i] is not None}
        kb = {_kind(r[i]) for r in b if r[i] is not None}
        if ka != kb:
            return f"column {n}: {ka} vs {kb}"
    if a != b:
        x, y = next((x, y) for x, y in zip(a, b) if x != y)
        return f"values in {order}: spark {str(x)[:600]} sql {str(y)[:600]}"
    return None
