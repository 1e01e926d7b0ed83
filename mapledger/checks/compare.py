"""Run a query in Spark and its SQL in DuckDB, and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types and rows agree, otherwise what differs."""
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} in Spark, {sorted(names)} in SQL"
    types = {c[0]: _family(str(c[1])) for c in answer.description}
    other = {field.name: _family(field.dataType.simpleString()) for field in df.schema}
    if types != other:
        return f"types: {sorted(other.items() - types.items())} in Spark, {sorted(types.items() - other.items())} in SQL"
    wanted = Counter(answer.fetchall())
    found = Counter(tuple(row) for row in df.select(*names).collect())
    if wanted == found:
        return None
    return (
        f"{found.total()} rows in Spark, {wanted.total()} in SQL; "
        f"only in Spark {list((found - wanted).items())[:3]}, only in SQL {list((wanted - found).items())[:3]}"
    )


def _family(name: str) -> str:
    name = name.lower()
    return {
        "varchar": "string", "string": "string", "number": "number", "integer": "int", "int": "int", "bigint": "bigint",
        "datetime": "timestamp", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    }.get(name, name)
