"""Positions inside ordered groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.storage import materialise

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def ordinal_in_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``ordinal`` (from 0) and ``group_rows``, the position in and size of each group.

    row_number() would sort a whole group in one task. Here the rows are range-sorted
    by key and order, so a large group spans many sorted slices, and a random last key
    spreads rows that are equal in everything else. That key is stored with the rows
    before they are shuffled on it, so a task that is run again routes them the same
    way. The slices are stored once; a second, small table counts each group's rows per
    slice, and their running total is where the slice starts inside the group.
    """
    spread = materialise(df.withColumn("_tie", F.rand(7)), "spread")
    # One slice per input split: their number grows with the data, and AQE keeps it.
    slices = spread.rdd.getNumPartitions()
    ranged = spread.repartitionByRange(slices, *keys, *order, "_tie").sortWithinPartitions(*keys, *order, "_tie")
    sliced = materialise(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "slices")

    slice_no = F.expr(f"shiftright(_at, {_SLICE_BITS})").alias("_slice")
    runs = sliced.groupBy(*keys, slice_no).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *keys,
        "_slice",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("group_rows"),
    )
    # Null keys are groups too, so the join compares them null-safely.
    positions = materialise(starts, "starts").alias("p")
    rows = sliced.withColumn("_slice", slice_no).alias("r")
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"p.{name}")) for name in (*keys, "_slice")]
    joined = rows.join(positions, same, "inner")
    return joined.select(
        *(F.col(f"r.{name}") for name in df.columns),
        (F.col("r._at") + F.col("p._shift")).alias("ordinal"),
        F.col("p.group_rows").alias("group_rows"),
    )
