"""Runs a query and its oracle over the same Parquet and compares schema and rows."""

from __future__ import annotations

import time
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


# Families of types that hold the same values.
KIND = {"int64": "int", "int32": "int", "double": "float", "float": "float"}


def kinds(table) -> dict[str, str]:
    return {
        f.name: str(f.type).replace("large_", "").replace("decimal128", "DECIMAL")
        for f in table.schema
    }


def rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def compare(spark, folder: str, name: str, query, sql: str | None) -> dict:
    start = time.time()
    got = query(spark, folder).toArrow()
    out = {"name": name, "sec": round(time.time() - start, 2), "rows": got.num_rows}
    if sql is None:
        return out | {"ok": got.num_rows > 0, "check": "rows"}
    start = time.time()
    want = duck(folder).sql(sql).to_arrow_table()
    out |= {"duck_sec": round(time.time() - start, 2), "check": "sql"}
    a, b = kinds(got), kinds(want)
    if a != b:
        return out | {"ok": False, "why": f"types {a} != {b}"}
    x, y = rows(got), rows(want)
    bad = [(p, q) for p, q in zip(x, y) if p != q]
    ok = len(x) == len(y) and not bad
    return out | ({"ok": ok} if ok else {"ok": False, "why": f"{len(x)} / {len(y)} rows, {bad[:2]}"})
