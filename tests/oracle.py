"""Comparing a Spark result with DuckDB over the same Parquet files."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, as sorted text; floats keep all digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def spark_rows(df) -> list[tuple]:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql: str) -> list[tuple]:
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return rows_of(columns, result.fetchall())


def sql_columns(connection, sql: str) -> list[str]:
    return sorted(c[0] for c in connection.execute(sql).description)
