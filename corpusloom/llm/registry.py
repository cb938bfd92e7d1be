"""Queries of this subpackage's operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register
