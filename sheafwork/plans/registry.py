"""Where queries and the SQL for their rows are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with DuckDB SQL for the same rows if there is any; a name is taken once."""

    def put(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return put
