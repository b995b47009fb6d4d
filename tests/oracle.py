"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return f"{value + 0.0:.10g}"
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    cols = sorted(frame.columns)
    return sorted(tuple(_plain(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False))


def compare(spark, sf_dir: str, name: str, queries: dict, sql: dict) -> str | None:
    """None when equal, else what differs."""
    got = queries[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(sql[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
