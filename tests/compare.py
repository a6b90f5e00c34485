"""Comparison of a query with its SQL over the same tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement, in words; empty if nothing does."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(columns)}"]
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return []
    return [f"{missing.total()} missing, {extra.total()} extra of {expected.total()}",
            f"missing {list(missing)[:2]}", f"extra {list(extra)[:2]}"]
