"""Joining large tables with derived lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from isobar.storage import materialise


def lookup(facts: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``facts`` with a derived table that is usually far smaller.

    The table is computed once and stored, so its size is known before the join is
    planned: below spark.sql.autoBroadcastJoinThreshold Catalyst broadcasts it and
    ``facts`` is never shuffled; above it, it is a sort-merge join whose hot keys AQE
    splits.
    """
    return facts.join(materialise(table, "lookup"), keys, how)
