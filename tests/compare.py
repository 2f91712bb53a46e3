"""Comparison of a Spark result with a DuckDB result: columns by name, rows without order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """(number of rows, description of what differs or '')."""
    rel = con.execute(sql)
    want_cols, want = _sorted_rows([d[0] for d in rel.description], rel.fetchall())
    got_cols, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} instead of {want_cols}"
    if got != want:
        extra = sorted(set(got) - set(want))[:2]
        missing = sorted(set(want) - set(got))[:2]
        return len(got), f"{len(got)} rows instead of {len(want)}; only here {extra}; only in SQL {missing}"
    return len(got), ""
