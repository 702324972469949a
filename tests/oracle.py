"""Compare registered queries with their SQL twins."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9) if abs(v) < 1e6 else round(v, 4)
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


_KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> list[str]:
    """Differences in columns, types and rows."""
    df = query(spark, sf_dir)
    got = df.collect()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    out = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for column, kind in df.dtypes:
        if _KINDS.get(kinds[column], kinds[column]) != kind:
            out.append(f"type of {column}: {kind} != {kinds[column]}")
    a, b = _rows(df.columns, got), _rows(columns, expected)
    if a != b:
        out.append(f"rows {sum(a.values())} / {sum(b.values())}, sorted columns {sorted(columns)}")
        out += [f"  only here: {r}" for r in list((a - b))[:3]]
        out += [f"  only in SQL: {r}" for r in list((b - a))[:3]]
    return out
