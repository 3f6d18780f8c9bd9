"""Compares a Spark result with DuckDB's answer on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return round(x, 6) + 0.0
    return x


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want_cols, want = rel.columns, rel.fetchall()
    out = []
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} != {sorted(want_cols)}"]
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    a, b = _rows(got_cols, got), _rows(want_cols, want)
    if a != b:
        out.append(f"only Spark: {list((a - b).elements())[:2]}; only SQL: {list((b - a).elements())[:2]}")
    if not want:
        out.append("no rows")
    kinds = dict(zip(want_cols, map(str, rel.types)))
    expected = {
        "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "date": {"DATE"},
        "timestamp_ntz": {"TIMESTAMP"}, "boolean": {"BOOLEAN"}, "float": {"FLOAT"},
    }
    for name, kind in df.dtypes:
        if kinds[name] not in expected.get(kind, set()):
            out.append(f"type of {name}: {kind} / {kinds[name]}")
    return out
