"""Compare a registered query with its SQL counterpart in DuckDB, values and types."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows, ordered: bool = False) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], picked if ordered else sorted(picked, key=repr)


def spark_rows(df, ordered: bool = False):
    return rows_of(df.columns, [tuple(r) for r in df.collect()], ordered)


def duck_rows(con, sql: str, ordered: bool = False):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall(), ordered)


def difference(df, con, sql: str, ordered: bool = False) -> str | None:
    """None if equal, else the first difference; ``ordered`` results have to agree in their order, too."""
    spark_columns, got = spark_rows(df, ordered)
    duck_columns, want = duck_rows(con, sql, ordered)
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None
