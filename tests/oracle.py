"""Run a query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(plain, key=repr)


def differences(con, df, sql, limit=5):
    """Empty when both results hold the same rows."""
    cursor = con.execute(sql)
    expected_names, expected = _rows([c[0] for c in cursor.description], cursor.fetchall())
    names, found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    if len(found) != len(expected):
        return [f"{len(found)} rows, expected {len(expected)}", found[:limit], expected[:limit]]
    wrong = [(f, e) for f, e in zip(found, expected) if f != e]
    return ([f"{len(wrong)} of {len(found)} rows differ"] + wrong[:limit]) if wrong else []
