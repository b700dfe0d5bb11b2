"""Compare a query with its SQL as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # -0.0 and 0.0 are one value
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    cursor = connection.execute(sql)
    wanted_columns = [column[0] for column in cursor.description]
    wanted = bag(wanted_columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(wanted_columns)
    found = bag(df.columns, [tuple(row) for row in df.collect()])
    missing, extra = wanted - found, found - wanted
    assert not missing and not extra, (
        f"{sum(missing.values())} rows missing, {sum(extra.values())} extra of {sum(wanted.values())}; "
        f"columns {sorted(df.columns)}; missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    )
    return sum(wanted.values())
