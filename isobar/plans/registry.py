"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(run: Run) -> Run:
        key = name or run.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key!r} registered twice")
        _QUERIES[key] = Query(key, run, sql)
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def second_text(column: str) -> Column:
    """A timestamp as text to the second, which every engine prints alike."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def day_text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)
