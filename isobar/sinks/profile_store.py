"""Stored profile states: every ingest adds a part, readers merge the parts that count."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from isobar.operators import profile_state
from isobar.sinks import manifest


def _root(base: str) -> str:
    return f"{base}/profile_state"


def _write(moments: DataFrame, values: DataFrame, folder: str) -> None:
    # A lost writer leaves a folder that no manifest names; the next one writes over it.
    moments.write.mode("overwrite").parquet(f"{folder}/moments")
    values.write.mode("overwrite").parquet(f"{folder}/values")


def add_days(daily: DataFrame, base: str, name: str | None = None) -> bool:
    """Add days that are in no state yet; days stored before are not read.

    An ingest with a ``name`` counts once: False if it is in the store already.
    """
    spark, root = daily.sparkSession, _root(base)
    before = manifest.newest(spark, root)
    part = f"days-{name or uuid.uuid4().hex}"
    if part in before.parts or part in before.covered:
        return False
    _write(profile_state.moments_of(daily), profile_state.ranks_of(daily), f"{root}/{part}")
    manifest.commit(spark, root, before, (*before.parts, part))
    return True


def stored_state(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(moments, values) of all parts that count, not merged yet."""
    root = _root(base)
    parts = manifest.newest(spark, root).parts
    if not parts:
        raise ValueError(f"no profile state is stored below {base}")
    moments, values = (
        spark.read.parquet(*(f"{root}/{part}/{kind}" for part in parts)) for kind in ("moments", "values")
    )
    return moments, values


def stored_full_profile(spark: SparkSession, base: str) -> DataFrame:
    return profile_state.full_profile_from(*stored_state(spark, base))


def stored_seasonal_profile(spark: SparkSession, base: str) -> DataFrame:
    return profile_state.seasonal_from(stored_state(spark, base)[0])


def compact_state(spark: SparkSession, base: str) -> None:
    """Merge all parts into one; the names of the ingests in it stay known."""
    root = _root(base)
    before = manifest.newest(spark, root)
    if len(before.parts) < 2:
        return
    moments, values = stored_state(spark, base)
    part = f"merged-{uuid.uuid4().hex}"
    merged = profile_state.merged_moments(moments, profile_state.KEYS)
    _write(merged, profile_state.merged_values(values), f"{root}/{part}")
    known = dict(before.covered) | {name: 1 for name in before.parts if name.startswith("days-")}
    manifest.commit(spark, root, before, (part,), known)
