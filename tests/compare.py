"""Compare a Spark result with what DuckDB returns for the oracle SQL."""

from __future__ import annotations

import math
import os

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

from checks.registry import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for table in BASE:
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp" + ("" if t.tz is None else "tz")
    if pa.types.is_null(t):
        return "null"
    return str(t)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What is wrong, or None if both give the same rows and types."""
    got, want = df.toArrow(), con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    for name in got.column_names:
        a, b = _kind(got.schema.field(name).type), _kind(want.schema.field(name).type)
        if a != b:
            return f"type of {name}: {a} != {b}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    bad = [(a, b) for a, b in zip(_rows(got), _rows(want), strict=True) if not _same(a, b)]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def _same(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b, strict=True):
        if isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y):
            continue
        if x != y:
            return False
    return True
