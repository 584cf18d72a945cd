"""Registered queries: a callable on (session, table folder) and its SQL check, if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function under its own name, with the SQL that must give the same rows."""

    def wrap(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if check:
            CHECKS[fn.__name__] = check
        return fn

    return wrap
