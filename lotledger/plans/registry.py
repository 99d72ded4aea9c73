"""Registry of named queries, each with the SQL that says the same on the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def configured(spark: SparkSession, sf: str) -> DataFrame:
            return run(configure(spark), sf)

        QUERIES[name] = configured
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add
