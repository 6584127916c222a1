"""Queries by name, with their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitelens.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL it must agree with."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @functools.wraps(function)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(spark, folder)

        QUERIES[name] = prepared
        if sql is not None:
            SQL[name] = sql
        return function

    return register
