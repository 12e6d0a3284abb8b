"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import prepare
from wardflow.sources.adapter import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with the SQL it must agree with."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(prepare(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register
