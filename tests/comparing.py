"""Compare a Spark result with DuckDB's result for the same tables, row by row."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

FAMILY = {
    "TINYINT": "int",
    "SMALLINT": "int",
    "INTEGER": "int",
    "BIGINT": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    '"NULL"': "null",
    "tinyint": "int",
    "smallint": "int",
    "int": "int",
    "bigint": "int",
    "string": "string",
    "double": "double",
    "float": "double",
    "boolean": "boolean",
    "date": "date",
    "void": "null",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(df, connection, sql: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: FAMILY.get(str(d[1]), str(d[1])) for d in result.description}
    expected_rows = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    for name, kind in df.dtypes:
        if FAMILY.get(kind, kind) != kinds[name]:
            problems.append(f"{name} is {kind}, SQL gives {kinds[name]}")
    order = sorted(names)
    positions = [names.index(name) for name in order]
    expected = Counter(tuple(cell(row[i]) for i in positions) for row in expected_rows)
    actual = Counter(tuple(cell(row[name]) for name in order) for row in df.collect())
    if sum(expected.values()) != sum(actual.values()):
        problems.append(f"{sum(actual.values())} rows instead of {sum(expected.values())}")
    if expected != actual:
        sort = lambda rows: sorted(rows, key=lambda r: [repr(x) for x in r])
        problems.append(
            f"{order}: only in Spark {sort((actual - expected))[:3]},"
            f" only in SQL {sort((expected - actual))[:3]}"
        )
    if not expected:
        problems.append("no rows")
    return problems
