"""Runs a query and its SQL on the same tables and compares rows without order."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        source = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{source}'")
    return con


def key(row: tuple) -> list[str]:
    return [repr(x) for x in row]


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if columns and rows agree, else what differs."""
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()), key=key)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} and {sorted(relation.columns)}"
    want = sorted(relation.select(*[f'"{c}"' for c in names]).fetchall(), key=key)
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; {[r for r in got if r not in set(want)][:2]} {[r for r in want if r not in set(got)][:2]}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if key(a) != key(b)]
    return f"{len(bad)} of {len(got)} rows: {bad[:2]}" if bad else ""
