"""Comparing a Spark result with a DuckDB one, regardless of row and column order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


def differences(df, con, sql: str, show: int = 3) -> list[str]:
    """What differs; empty when both results are equal."""
    got_names, got = _rows(df.columns, df.collect())
    relation = con.sql(sql)
    want_names, want = _rows(relation.columns, relation.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} instead of {want_names}"]
    problems = []
    if len(got) != len(want):
        problems.append(f"{len(got)} rows instead of {len(want)}")
    if got != want:
        wanted, have = set(want), set(got)
        problems += [f"only Spark: {r!r}"[:600] for r in got if r not in wanted][:show]
        problems += [f"only DuckDB: {r!r}"[:600] for r in want if r not in have][:show]
        problems = problems or ["different multiplicities"]
    return problems
