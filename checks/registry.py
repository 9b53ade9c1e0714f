"""Where queries and their oracle SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by the small-frame tests only."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
