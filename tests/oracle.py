"""Side-by-side comparison of the registered queries and their SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    """Columns by name with their types, and rows in a fixed order."""
    names = sorted(table.column_names)
    kinds = []
    for name in names:
        kind = table.schema.field(name).type
        kinds.append((name, "string" if pa.types.is_large_string(kind) else str(kind)))
    columns = [table.column(name).to_pylist() for name in names]
    rows = sorted(zip(*columns), key=repr) if columns else []
    return kinds, rows


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    left, right = canonical(spark_table), canonical(sql_table)
    found = []
    if left[0] != right[0]:
        found.append(f"columns differ: {left[0]} against {right[0]}")
    if len(left[1]) != len(right[1]):
        found.append(f"row counts differ: {len(left[1])} against {len(right[1])}")
    elif left[1] != right[1]:
        pairs = [(a, b) for a, b in zip(left[1], right[1]) if repr(a) != repr(b)]
        if pairs:
            found.append(f"{len(pairs)} row(s) differ, first: {pairs[0]}")
    return found
