"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def plain(kind: pa.DataType) -> str:
    return {"large_string": "string"}.get(str(kind), str(kind))


def schema_of(table: pa.Table) -> dict[str, str]:
    return {field.name: plain(field.type) for field in sorted(table.schema, key=lambda f: f.name)}


def rows_of(table: pa.Table) -> list[tuple]:
    columns = sorted(table.column_names)
    values = [table.column(name).to_pylist() for name in columns]
    return sorted(zip(*values), key=repr)


def compare(frame, connection, sql: str) -> None:
    ours = frame.toArrow()
    theirs = connection.execute(sql).to_arrow_table()
    assert schema_of(ours) == schema_of(theirs)
    left, right = rows_of(ours), rows_of(theirs)
    assert len(left) == len(right)
    different = [pair for pair in zip(left, right) if repr(pair[0]) != repr(pair[1])]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
