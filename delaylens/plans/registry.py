"""Registry of bound queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaylens.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name by default, with the SQL for the same result if there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        key = name or function.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register
