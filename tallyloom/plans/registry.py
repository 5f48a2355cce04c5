"""The catalogue: each query with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name (without a last underscore), with its SQL twin if there is one."""

    def register(f: Query) -> Query:
        name = f.__name__.rstrip("_")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register
