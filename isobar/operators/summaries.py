"""Counts and averages behind the charts and dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.functions.levels import any_raised, raised
from isobar.functions.places import known

# The range of weather codes.
CODES = tuple(range(100))


def alert_distribution(readings: DataFrame) -> DataFrame:
    """Alerts per kind and level, as long rows (kind, level, alerts).

    The four counts come from one aggregation; a level nobody reached shows 0.
    """
    cells = [(kind, level) for kind in ("wind", "heat") for level in ("level_1", "level_2")]
    counted = readings.agg(
        *(F.count_if(F.col(f"{kind}_alert_level") == level).alias(f"{kind}_{level}") for kind, level in cells)
    )
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), F.col(f"{kind}_{level}").alias("alerts"))
        for kind, level in cells
    ]
    return counted.select(F.inline(F.array(*rows)))


def weathercode_histogram(readings: DataFrame) -> DataFrame:
    coded = readings.where("weathercode is not null")
    return coded.groupBy(known("country").alias("country"), "weathercode").agg(F.count(F.lit(1)).alias("readings"))


def weathercode_matrix(readings: DataFrame, codes: Sequence[int] = CODES) -> DataFrame:
    """Countries by codes, zero-filled; a column ``code_N`` for each of ``codes``.

    ``code_other`` counts the readings with any other code, so no reading is lost.
    """
    shown = sorted(set(codes))
    counted = weathercode_histogram(readings).select(
        "country", F.when(F.col("weathercode").isin(*shown), F.col("weathercode")).alias("code"), "readings"
    )
    # The histogram is small; its null code gathers all that are not shown.
    pivoted = counted.groupBy("country").pivot("code", [*shown, None]).agg(F.sum("readings"))
    names = [*(f"code_{code}" for code in shown), "code_other"]
    return pivoted.toDF("country", *names).fillna(0, subset=names)


def weathercode_mode(readings: DataFrame) -> DataFrame:
    """Most frequent code per country with its count and the country's total."""
    histogram = weathercode_histogram(readings)
    country = Window.partitionBy("country")
    ranked = histogram.withColumns(
        {
            "total": F.sum("readings").over(country),
            "rank": F.row_number().over(country.orderBy(F.desc("readings"), "weathercode")),
        }
    )
    return ranked.where("rank = 1").drop("rank")


def wind_alerts_by_city(readings: DataFrame) -> DataFrame:
    return readings.where(raised("wind_alert_level")).groupBy("city").agg(F.count(F.lit(1)).alias("total_alerts"))


def heat_alerts_by_country(readings: DataFrame) -> DataFrame:
    return readings.where(raised("heat_alert_level")).groupBy("country").agg(F.count(F.lit(1)).alias("total_alerts"))


def average_temperature_by_place(readings: DataFrame) -> DataFrame:
    return readings.groupBy("country", "city").agg(F.avg("temperature").alias("avg_temp"))


def alerts_per_place(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.groupBy("country", "city").agg(F.count(F.lit(1)).alias("alerts"))


def history_summary(daily: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Days, temperature range and total precipitation, overall or per group."""
    return daily.groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"),
        F.min("temperature_mean").alias("min_temperature"),
        F.max("temperature_mean").alias("max_temperature"),
        F.sum("precipitation").alias("total_precipitation"),
    )


def stream_totals(datasets: dict[str, DataFrame], retained: int = 1000) -> DataFrame:
    """Rows per dataset, and how many of them a buffer of ``retained`` would hold."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("dataset"), "total")
        for name, df in datasets.items()
    ]
    totals = counted[0]
    for other in counted[1:]:
        totals = totals.unionByName(other)
    return totals.withColumn("retained", F.least("total", F.lit(retained).cast("long")))


def batch_statistics(batch: DataFrame, key: str, flag: str | None = None) -> DataFrame:
    """One row about a micro-batch: rows, distinct keys and flagged rows."""
    flagged = F.count_if(F.col(flag)) if flag else F.lit(0).cast("long")
    return batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        flagged.alias("anomalies"),
    )


#: Size of a sketch of keys: its estimates are off by about 1 % at most times, far less for few keys.
KEY_SKETCH = 14


def key_sketch(key: Column) -> Column:
    """A sketch of distinct keys that merges with others; an observation can carry it."""
    return F.hll_sketch_agg(key, F.lit(KEY_SKETCH))


def statistics_row(spark: SparkSession, rows: int, anomalies: int, keys: bytes | None) -> DataFrame:
    """One row about a micro-batch like batch_statistics(), its distinct keys estimated, with their sketch."""
    made = spark.createDataFrame([(rows, anomalies, keys)], "rows bigint, anomalies bigint, keys binary")
    return made.select("rows", F.coalesce(F.hll_sketch_estimate("keys"), F.lit(0)).alias("distinct_keys"), "anomalies", "keys")


def merged_statistics(batches: DataFrame) -> DataFrame:
    """Totals over all micro-batches; a key that occurs in many of them counts once."""
    return batches.agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("keys")), F.lit(0)).alias("distinct_keys"),
        F.sum("anomalies").alias("anomalies"),
    )


def alert_totals(readings: DataFrame) -> DataFrame:
    """Total readings with any alert beside the per-kind counts."""
    return readings.agg(
        F.count_if(any_raised()).alias("total_alerts"),
        F.count_if(raised("wind_alert_level")).alias("wind_alerts"),
        F.count_if(raised("heat_alert_level")).alias("heat_alerts"),
    )
