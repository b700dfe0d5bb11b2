"""Extreme days per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CITY = ["country", "city"]

_NEEDED = ["temperature_max", "temperature_min", "windspeed_max", "precipitation"]


# Tasks or parts whose rows of a group are reduced together.
_FAN_IN = 64


def _ranked(df: DataFrame, keys: list[Column | str], order: list[Column], k: int, rank: str) -> DataFrame:
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def tree_levels(tasks: int, fan_in: int) -> int:
    """Levels of parts below the final one so that nothing meets the rows of more than ``fan_in`` of the level below."""
    levels, left = 0, tasks
    while left > fan_in:
        levels, left = levels + 1, -(-left // fan_in)
    return levels


def top_k_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    rank: str = "rank",
    fan_in: int = _FAN_IN,
    tasks: int | None = None,
) -> DataFrame:
    """First ``k`` rows of each group in ``order``, numbered from 1.

    A tree reduces a group that many tasks contribute to: every task keeps its own k
    rows, a part the k best of ``fan_in`` tasks, the next level those of as many parts.
    ``tasks`` is about how many tasks deliver ``df``, by default the session's number of
    shuffle partitions. Spark limits the rows in each task up to the k of
    spark.sql.optimizer.windowGroupLimitThreshold, which build_session() sets; a session
    with a lower one gives the same rows and shuffles more of them.
    """
    if tasks is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At least one: a scan may have more tasks than a shuffle.
    levels = max(1, tree_levels(tasks, fan_in))
    reduced = df.withColumn("_task", F.spark_partition_id())
    for level in range(1, levels + 1):
        part = F.floor(F.col("_task") / fan_in**level)
        reduced = _ranked(reduced.withColumn("_part", part), [*keys, "_part"], order, k, "_rank").drop("_rank", "_part")
    return _ranked(reduced.drop("_task"), keys, order, k, rank)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order``: every task keeps its own k, then those are merged."""
    return df.orderBy(*order).limit(k)


def _latest(value: Column, *carried: str) -> Column:
    """Largest value; among equals the latest date, then the largest carried fields."""
    return F.max(F.struct(value.alias("value"), "date", *carried))


def climate_records(daily: DataFrame) -> DataFrame:
    """Hottest, coldest, windiest and wettest day per city, latest day on ties.

    One aggregation answers all four questions: the coldest day is the largest negated
    minimum, and each winner carries its own date.
    """
    days = daily.dropna(subset=_NEEDED)
    best = days.groupBy(*CITY).agg(
        _latest(F.col("temperature_max"), "latitude", "longitude").alias("hot"),
        _latest(-F.col("temperature_min")).alias("cold"),
        _latest(F.col("windspeed_max")).alias("wind"),
        _latest(F.col("precipitation")).alias("rain"),
        F.count(F.lit(1)).alias("total_days"),
    )
    return best.select(
        *CITY,
        F.col("hot.latitude").alias("latitude"),
        F.col("hot.longitude").alias("longitude"),
        F.col("hot.date").alias("max_temp_date"),
        F.col("hot.value").alias("max_temperature"),
        F.col("cold.date").alias("min_temp_date"),
        (-F.col("cold.value")).alias("min_temperature"),
        F.col("wind.date").alias("max_wind_date"),
        F.col("wind.value").alias("max_windspeed"),
        F.col("rain.date").alias("max_precip_date"),
        F.col("rain.value").alias("max_precipitation"),
        "total_days",
    )
