"""Archives of micro-batches, and their compaction into generations.

A running job adds a folder for each micro-batch. Compacting gathers the finished batches
into a generation with few files per place, and a manifest then says up to which batch of
each run the generations hold the rows. Readers take the generations and the batches
behind them, so a row is there once before, during and after a compaction, also if it is
cut short; the job that writes need not stop.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from isobar.sinks import manifest

_GENERATIONS = "_generations"


def _with_batches(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("run_id", StringType()).add("batch_id", LongType())


def _within(first: dict[str, int], last: dict[str, int]) -> Column:
    """Rows of batches behind ``first`` and up to ``last`` of each run."""
    spans = [
        (F.col("run_id") == run) & (F.col("batch_id") > first.get(run, -1)) & (F.col("batch_id") <= number)
        for run, number in last.items()
    ]
    return F.coalesce(reduce(lambda a, b: a | b, spans, F.lit(False)), F.lit(False))


def _part(spark: SparkSession, path: str, part: str, schema: StructType) -> DataFrame:
    folder = f"{path}/{part}"
    return spark.read.schema(_with_batches(schema)).option("basePath", folder).json(folder)


def read_archive(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All archived rows; folders of batches that a generation holds are not opened."""
    state = manifest.newest(spark, path)
    if not state.number:
        return spark.read.schema(schema).json(path)
    batches = spark.read.schema(_with_batches(schema)).json(path).where(~_within({}, dict(state.covered)))
    return reduce(DataFrame.unionByName, [batches, *(_part(spark, path, part, schema) for part in state.parts)])


def finished_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The last finished batch of each run; the job writes them one after the other."""
    last: dict[str, int] = {}
    for name in manifest.listed(spark, f"{path}/run_id=*/batch_id=*/_SUCCESS"):
        run, number = (folder.split("=", 1)[1] for folder in name.split("/")[-3:-1])
        last[run] = max(last.get(run, -1), int(number))
    return last


def compact_archive(spark: SparkSession, path: str, schema: StructType, partitions: list[str], full: bool = False) -> bool:
    """Gather the batches finished since the last compaction into a new generation.

    With ``full`` the earlier generations are written anew as part of it. False if there
    is nothing to gather.
    """
    before = manifest.newest(spark, path)
    last = finished_batches(spark, path)
    if not any(number > before.covered.get(run, -1) for run, number in last.items()) and not (full and len(before.parts) > 1):
        return False
    rows = spark.read.schema(_with_batches(schema)).json(path).where(_within(dict(before.covered), last))
    if full:
        rows = reduce(DataFrame.unionByName, [rows, *(_part(spark, path, part, schema) for part in before.parts)])
    part = f"{_GENERATIONS}/{uuid.uuid4().hex}"
    placed = rows.drop("run_id", "batch_id").hint("rebalance", *partitions)
    placed.write.partitionBy(*partitions).json(f"{path}/{part}")
    parts = (part,) if full else (*before.parts, part)
    manifest.commit(spark, path, before, parts, dict(before.covered) | last)
    return True


def drop_covered(spark: SparkSession, path: str) -> int:
    """Remove batch folders that generations hold, and generations that no longer count.

    For archives that nobody reads at the moment with an earlier manifest. The last batch
    of a run stays: a job that was cut off may write it again.
    """
    state = manifest.newest(spark, path)
    dead = []
    for name in manifest.listed(spark, f"{path}/run_id=*/batch_id=*"):
        run, number = (folder.split("=", 1)[1] for folder in name.split("/")[-2:])
        if int(number) < state.covered.get(run, -1):
            dead.append(name)
    live = {part.rsplit("/", 1)[1] for part in state.parts}
    if state.number:
        dead += [name for name in manifest.listed(spark, f"{path}/{_GENERATIONS}/*") if name.rsplit("/", 1)[1] not in live]
    for name in dead:
        manifest.remove(spark, name)
    return len(dead)
