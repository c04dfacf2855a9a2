"""All queries over the shared tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Adds the decorated query under ``name``."""

    def put(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return put
