"""Keyed messages from a topic or from files, batch and streaming.

Every reader returns (key, value, timestamp, topic, partition, offset).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.records import top_k
from isobar.schemas import MESSAGE

KINDS = ("kafka", "json", "parquet", "text")


def _open(spark: SparkSession, reader, kind: str, location: str, options: dict[str, str]) -> DataFrame:
    if kind == "kafka":
        loaded = reader.format("kafka").option("subscribe", location).options(**options).load()
        return loaded.select(
            F.col("key").cast("string"), F.col("value").cast("string"), *MESSAGE.fieldNames()[2:]
        )
    if kind == "text":
        lines = reader.format("text").options(**options).load(location)
        return lines.select(
            F.lit(None).cast("string").alias("key"),
            "value",
            F.col("_metadata.file_modification_time").alias("timestamp"),
            F.col("_metadata.file_name").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(None).cast("bigint").alias("offset"),
        )
    if kind in KINDS:
        return reader.format(kind).schema(MESSAGE).options(**options).load(location)
    raise ValueError(f"unknown message source {kind!r}, expected one of {KINDS}")


def message_stream(
    spark: SparkSession, kind: str, location: str, start: str = "latest", **options: str
) -> DataFrame:
    """Messages as they arrive. ``start`` is "latest" or "earliest"; files always start at the first."""
    if kind == "kafka":
        options.setdefault("startingOffsets", start)
    return _open(spark, spark.readStream, kind, location, options)


def message_table(spark: SparkSession, kind: str, location: str, **options: str) -> DataFrame:
    """All messages there are now, from the earliest on."""
    if kind == "kafka":
        options.setdefault("startingOffsets", "earliest")
    return _open(spark, spark.read, kind, location, options)


def _reach(messages: DataFrame, limit: int) -> Column | None:
    """A condition on partition and offset that holds for the first ``limit`` readable messages.

    Spans of offsets are widened, each twice the one before, partition after partition,
    until so many are found. None if some messages have no place in a log.
    """
    places = messages.groupBy("partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count_if(F.col("offset").isNull()).alias("lost")
    )
    partitions = sorted(places.collect(), key=lambda row: (row["partition"] is not None, row["partition"]))
    if any(row["partition"] is None or row["lost"] for row in partitions):
        return None
    missing = limit
    for row in partitions:
        at, span = row["first"], 2 * limit
        while at <= row["last"]:
            until = at + span
            own = (F.col("partition") == row["partition"]) & (F.col("offset") >= at) & (F.col("offset") < until)
            # Enough is enough: no more are counted than are missing.
            missing -= messages.where(own).where(_readable()).limit(missing).count()
            if missing <= 0:
                here = (F.col("partition") == row["partition"]) & (F.col("offset") < until)
                return here | (F.col("partition") < row["partition"])
            at, span = until, 2 * span
    return F.lit(True)


def _readable() -> Column:
    return F.try_parse_json("value").isNotNull()


def first_messages(messages: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` messages in log order whose payload is JSON.

    Of a log only the beginning is read that holds them: the condition on partition and
    offset reaches the scan. Lines of text have no offset; they come in the order of their
    files' times and names.
    """
    reach = _reach(messages, limit) if limit > 0 else None
    readable = (messages if reach is None else messages.where(reach)).where(_readable())
    order = ("partition", "offset", "timestamp", "topic", "value")
    return top_k(readable, [F.asc(name) for name in order], limit)
