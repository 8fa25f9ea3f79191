"""Where registered queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotloom.operators.adapter import LOG_SQL, LOTS_SQL, MASTER_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The entities as SQL, to be put before a query.
LOTS, LOG, ALL = f"WITH {LOTS_SQL}", f"WITH {LOTS_SQL}, {LOG_SQL}", f"WITH {LOTS_SQL}, {LOG_SQL}, {MASTER_SQL}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register
