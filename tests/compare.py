"""Strict comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, text):
    result = con.execute(text)
    return _sorted([d[0] for d in result.description], result.fetchall())


def difference(df, con, text) -> str | None:
    """None when columns, row count, values and value types all agree."""
    (sc, sr), (dc, dr) = spark_rows(df), duck_rows(con, text)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"{len(sr)} rows != {len(dr)} rows"
    for a, b in zip(sr, dr, strict=True):
        if a != b:
            return f"row {a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types differ: {a} {b}"
    return None
