"""Compare registered queries with their DuckDB SQL: columns, row count and values in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(float(value))
    return repr(value)


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> int:
    """Number of rows if both agree; raises AssertionError otherwise."""
    df = query(spark, sf_dir)
    got_columns, got = _ordered(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = _ordered([d[0] for d in result.description], result.fetchall())
    assert got_columns == want_columns, (got_columns, want_columns)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, f"{len(wrong)} rows differ, first: {wrong[0]}"
    return len(got)
