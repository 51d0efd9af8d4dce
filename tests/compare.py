"""Spark results beside DuckDB's: same columns, types, rows and values."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


def connect(sf_dir: str, folder: str | None = None) -> duckdb.DuckDBPyConnection:
    """A connection of its own, bounded so that it lives beside a Spark session."""
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    connection.execute("SET threads = 2")
    connection.execute("SET memory_limit = '3GB'")
    if folder:
        connection.execute(f"SET temp_directory = '{folder}'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _type(arrow_type: pa.DataType) -> str:
    if pa.types.is_large_string(arrow_type) or pa.types.is_string_view(arrow_type):
        return "string"
    if pa.types.is_timestamp(arrow_type):
        return "timestamp"
    return str(arrow_type)


def schema_of(result: pa.Table) -> list[tuple[str, str]]:
    return sorted((f.name, _type(f.type)) for f in result.schema)


def rows_of(result: pa.Table) -> list[str]:
    names = sorted(result.column_names)
    columns = [result.column(n).to_pylist() for n in names]
    return sorted(map(repr, zip(*columns)))


def differences(spark_result: pa.Table, oracle_result: pa.Table) -> list[str]:
    found = []
    if schema_of(spark_result) != schema_of(oracle_result):
        found.append(f"schema {schema_of(spark_result)} != {schema_of(oracle_result)}")
    if spark_result.num_rows != oracle_result.num_rows:
        found.append(f"{spark_result.num_rows} rows != {oracle_result.num_rows}")
    if not found:
        ours, theirs = rows_of(spark_result), rows_of(oracle_result)
        unequal = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
        if unequal:
            found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
