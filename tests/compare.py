"""Run registered queries on Spark and on DuckDB and compare all values."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Human-readable differences; empty if both sides agree exactly."""
    want = con.sql(sql)
    want_columns, want_rows = _sorted(want.columns, want.fetchall())
    got_columns, got_rows = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if want_columns != got_columns:
        return [f"columns {got_columns} instead of {want_columns}"]
    if len(want_rows) != len(got_rows):
        return [f"{len(got_rows)} rows instead of {len(want_rows)}"]
    kinds = {type(v) for r in got_rows for v in r} - {int, float, str, bool, type(None)}
    out = [f"unexpected types {kinds}"] if kinds else []
    out += [f"{g} instead of {w}" for g, w in zip(got_rows, want_rows) if repr(g) != repr(w)][:limit]
    return out
