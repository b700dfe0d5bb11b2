"""Views of the benchmark tables as weather data.

Fixed values: the formulas tie every test query to the same SQL over the same tables.
All numbers are multiples of 0.25, so sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.places import location_key
from isobar.operators.readings import grade_alerts
from isobar.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _city(number: Column) -> Column:
    return F.concat(F.lit("CITY_"), (number % 3).cast("string"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations: even nations are calm and mild, odd ones windy and extreme."""
    places = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    ordered = table(spark, sf_dir, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    calm = F.col("n_nationkey") % 2 == 0
    warmth = F.when(calm, F.col("l_quantity") * 0.5 - 5).otherwise(F.col("l_quantity") * 1.5 - 20)
    wind = F.col("l_partkey") % F.when(calm, 21).otherwise(130)
    swing = F.col("l_linenumber") * 0.5
    return lines.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.year("l_shipdate").alias("year"),
        F.col("n_name").alias("country"),
        _city(F.col("c_custkey")).alias("city"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (F.col("n_nationkey") * 2).cast("double").alias("longitude"),
        warmth.alias("temperature_mean"),
        (warmth + swing).alias("temperature_max"),
        (warmth - swing).alias("temperature_min"),
        (wind * 0.25).alias("windspeed_mean"),
        F.when(F.col("l_linenumber") != 7, wind * 0.5).alias("windspeed_max"),
        ((F.col("l_suppkey") % 40) * 0.25).alias("precipitation"),
    )


_CODES = {"click": 0, "view": 3, "purchase": 61, "signup": 80}


def as_readings(events: DataFrame) -> DataFrame:
    """Events as live readings of 75 places, some without city or wind."""
    gauge = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    code = F.coalesce(*(F.when(F.col("event_type") == kind, code) for kind, code in _CODES.items()), F.lit(95))
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("NATION_"), (user % 25).cast("string")).alias("country"),
        F.when(user % 50 != 7, _city(user)).alias("city"),
        (user % 90).cast("double").alias("latitude"),
        (user % 180).cast("double").alias("longitude"),
        (F.floor("value").cast("double") / 2).alias("temperature"),
        (F.nullif(gauge, F.lit(13)).cast("double") / 4).alias("windspeed"),
        code.alias("weathercode"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_alerts(readings(spark, sf_dir)).withColumn("location_key", location_key())


def moved_in_time(readings_df: DataFrame) -> DataFrame:
    """Readings moved back by 22 to 31 years and some months, so that they fall into the years of
    the daily observations and beside them."""
    number = F.col("reading_id")
    back = F.make_ym_interval(F.lit(22) + (number % 10).cast("int"), (number % 12).cast("int"))
    return readings_df.withColumn("event_time", F.col("event_time") - back)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream.

    The path is a pattern because a stream takes a plain path for a folder, and the
    table may be a single file.
    """
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def as_messages(readings_df: DataFrame) -> DataFrame:
    """Readings as nested JSON messages; every tenth gauge value sends junk instead.

    Junk is plain text, a JSON object of another kind, or nothing at all.
    """
    body = F.to_json(
        F.struct(
            F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.struct("latitude", "longitude", "city", "country").alias("location"),
            F.struct("temperature", "windspeed", "weathercode").alias("current_weather"),
            F.lit("open-meteo").alias("source"),
        )
    )
    junk = {1: "not json", 2: '{"msg": "Hello Kafka"}', 3: ""}
    return readings_df.select(
        location_key().alias("key"),
        F.coalesce(*(F.when(F.col("reading_id") % 10 == k, text) for k, text in junk.items()), body).alias("value"),
        F.col("event_time").alias("timestamp"),
        F.lit("weather_stream").alias("topic"),
        (F.col("reading_id") % 4).cast("int").alias("partition"),
        F.col("reading_id").alias("offset"),
    )


def history_documents(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """One seven-day history document per order, some with short or missing arrays.

    With ``whole`` it has all six series: precipitation (o_orderkey % 30 + i) * 0.25 and
    wind maxima (o_orderkey % 50 + i) * 0.5.

    Day i of an order has mean (o_orderkey % 40 + i) * 0.5 and wind (o_orderkey % 60 + i)
    * 0.25. Every fifth order lacks its last day's date, every third its last two means.
    """
    key = F.col("o_orderkey")
    first = F.col("o_orderdate").cast("date")
    steps = F.sequence(F.lit(0), F.lit(6))

    def series(base: Column, factor: float) -> Column:
        return F.transform(steps, lambda i: (base + i).cast("double") * factor)

    last_date = F.when(key % 5 == 0, 6).otherwise(7)
    time = F.transform(
        steps, lambda i: F.when(i < last_date, F.date_add(first, i).cast("string")).otherwise("")
    )
    mean = series(key % 40, 0.5)
    placed = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    location = F.struct(
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.when(F.col("n_nationkey") != 0, (F.col("n_nationkey") * 2).cast("double")).alias("longitude"),
        F.when(key % 7 != 0, _city(F.col("c_custkey"))).alias("city"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("location_name"),
    )
    more = [series(key % 30, 0.25).alias("precipitation_sum"), series(key % 50, 0.5).alias("windspeed_10m_max")] if whole else []
    arrays = F.struct(
        time.alias("time"),
        F.transform(mean, lambda t: t + 2.0).alias("temperature_2m_max"),
        F.transform(mean, lambda t: t - 2.0).alias("temperature_2m_min"),
        F.when(key % 3 == 0, F.slice(mean, 1, 5)).otherwise(mean).alias("temperature_2m_mean"),
        series(key % 60, 0.25).alias("windspeed_10m_mean"),
        *more,
    )
    document = F.struct(
        F.struct(location.alias("location")).alias("metadata"),
        F.struct(arrays.alias("daily")).alias("data"),
    )
    return placed.select("o_orderkey", F.to_json(document).alias("value"))
