"""Runs a query and its SQL over the same tables and compares the rows, columns by name."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in data), key=repr)


def _plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def difference(df, con, sql: str) -> str | None:
    got_rows = df.collect()
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    got, want = _rows(df.columns, got_rows), _rows(want_cols, cur.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:400]}" if wrong else None
