"""Batch writers; the streaming jobs call them per micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators.documents import place_for_storage


@dataclass(frozen=True)
class Batch:
    """One micro-batch: the run it belongs to, which lasts as long as its checkpoint, and its number."""

    run: str
    number: int

    def folder(self, path: str) -> str:
        return f"{path}/run_id={self.run}/batch_id={self.number}"


def send_messages(messages: DataFrame, kind: str, target: str, batch: Batch | None = None, **options: str) -> None:
    """Write (key, value) messages to a topic or as files.

    Files of a micro-batch are filed under its run and number and replace what an earlier
    attempt at the same batch left behind.
    """
    if kind == "kafka":
        messages.write.format("kafka").option("topic", target).options(**options).save()
    elif batch is None:
        messages.write.mode("append").format(kind).options(**options).save(target)
    else:
        archive_batch(messages, target, [], batch, kind)


def archive_batch(df: DataFrame, path: str, partitions: list[str], batch: Batch, kind: str = "json") -> None:
    """Add one micro-batch to a partitioned archive, once however often it is retried.

    The folder of the batch is written as a whole, so a retry leaves nothing of an earlier
    attempt, and a job that starts anew never meets the batches of another run.
    """
    # A hot place is split over several tasks, small ones share one.
    placed = df.hint("rebalance", *partitions) if partitions else df
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partitions).format(kind).save(batch.folder(path))


def compact_archive(archive: DataFrame, path: str, partitions: list[str], kind: str = "json") -> None:
    """Write an archive of many micro-batches anew elsewhere, with few files per partition.

    ``path`` must be another folder than the archive's own; readers take either.
    isobar.sinks.archive compacts an archive in place.
    """
    (
        archive.drop("run_id", "batch_id")
        .hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(kind)
        .save(path)
    )


def store_documents(documents: DataFrame, base: str, kind: str, by_year: bool = False) -> None:
    """Replace the stored documents of every city (and year) present in ``documents``."""
    partitions = ["country_dir", "city_dir", *(["year_dir"] if by_year else [])]
    placed = place_for_storage(documents)
    if by_year:
        placed = placed.withColumn("year_dir", F.col("year"))
    (
        placed.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .json(f"{base}/{kind}")
    )


def store_history(documents: DataFrame, base: str) -> None:
    """Land history documents, replacing those of the same city."""
    named = documents.select(
        F.col("metadata.location.country").alias("country"), F.col("metadata.location.city").alias("city"), "*"
    )
    placed = place_for_storage(named).drop("country", "city")
    (
        placed.hint("rebalance", "country_dir", "city_dir")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("country_dir", "city_dir")
        .json(f"{base}/history")
    )


def publish_documents(
    documents: DataFrame,
    messages: DataFrame | None,
    base: str | None,
    kind: str,
    sink: tuple[str, str] | None,
    by_year: bool = False,
    **options: str,
) -> None:
    """Store documents and send them as messages; leave ``base`` or ``sink`` out to skip one."""
    if base is not None:
        store_documents(documents, base, kind, by_year)
    if sink is not None and messages is not None:
        send_messages(messages, *sink, **options)
