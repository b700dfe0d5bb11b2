"""Scratch tables that cut lineage on storage every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; where none is set, the warehouse of a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_made: ContextVar[list[str] | None] = ContextVar("scratch tables of the scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside once it is left; what is kept must be written by then."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        files = spark._jvm.org.apache.hadoop.fs
        for path in made:
            place = files.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later stages restart from the files when executors are lost, and Catalyst now
    knows the real size, so it broadcasts this side of a join only when the bytes
    on storage are below spark.sql.autoBroadcastJoinThreshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
