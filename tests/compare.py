"""Runs a registered query and its SQL on the same tables and compares whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, int):
        return value
    return str(value) if value is not None else None


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def difference(spark_result, duck_result) -> str | None:
    """None when equal, else what differs."""
    if spark_result[0] != duck_result[0]:
        return f"columns {spark_result[0]} != {duck_result[0]}"
    a, b = spark_result[1], duck_result[1]
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows; only here {list(set(a) - set(b))[:2]}, only there {list(set(b) - set(a))[:2]}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{x} != {y}"
    return None
