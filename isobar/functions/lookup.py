"""Finding an entry in a sorted array of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_not_after(entries: Column, at: Column, field: str) -> Column:
    """The last of the ``entries``, ascending by ``field``, whose field is not after ``at``; else null.

    The array is halved until one place is left. Null entries, or a null ``at``, find nothing.
    """
    size = F.size(entries)

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        undecided = span["low"] < span["high"]
        before = F.coalesce(F.get(entries, middle)[field] <= at, F.lit(False))
        return F.struct(
            F.when(undecided & before, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(undecided & ~before, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.greatest(F.ceil(F.log2(size + 1)).cast("int"), F.lit(1))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), steps), start, halve)
    return F.get(entries, found["low"] - 1)
