"""Compare the rows of a case with those of its SQL in DuckDB."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

from acceptance.registry import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(con: duckdb.DuckDBPyConnection, name: str, df: DataFrame) -> tuple[int, list[str]]:
    """(rows, what differs). No differences: same columns and equal values."""
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = _sorted_rows(columns, cursor.fetchall())
    found = []
    if sorted(columns) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        found.append(f"only Spark {list(set(got) - set(want))[:2]}, only SQL {list(set(want) - set(got))[:2]}")
    return len(got), found
