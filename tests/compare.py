"""Strict comparison of a Spark result with DuckDB's result of its SQL counterpart."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
import pyarrow as pa


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def _value(v: object) -> object:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_value(v) for v in table[n].to_pylist()] for n in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    found = []
    left = {f.name: _kind(f.type) for f in spark_table.schema}
    right = {f.name: _kind(f.type) for f in duck_table.schema}
    if set(left) != set(right):
        return [f"columns: spark {sorted(set(left) - set(right))}, sql {sorted(set(right) - set(left))}"]
    found += [f"type of {n}: spark {left[n]}, sql {right[n]}" for n in left if left[n] != right[n]]
    a, b = rows(spark_table), rows(duck_table)
    if len(a) != len(b):
        found.append(f"rows: spark {len(a)}, sql {len(b)}")
    for x, y in zip(a, b):
        if x != y:
            names = sorted(left)
            cells = [f"{n}: {p!r:.300} / {q!r:.300}" for n, p, q in zip(names, x, y) if p != q]
            found.append("first difference: " + "; ".join(cells) + f" in {x!r:.300}")
            break
    return found


def run_sql(con: duckdb.DuckDBPyConnection, statement: str) -> pa.Table:
    return con.execute(statement).to_arrow_table()
