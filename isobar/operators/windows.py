"""Sliding and tumbling window metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.calendar import event_timestamp
from isobar.functions.levels import any_raised, raised
from isobar.functions.places import coordinate_key, location_key


def _alert_counts() -> dict[str, Column]:
    counts = {}
    for kind in ("wind", "heat"):
        level = f"{kind}_alert_level"
        counts[f"{kind}_alerts_count"] = F.count_if(raised(level))
        for step in (1, 2):
            counts[f"{kind}_level_{step}_count"] = F.count_if(F.col(level) == f"level_{step}")
    return counts | {"total_alerts_count": F.count_if(any_raised())}


def _metrics() -> list[Column]:
    measures = {
        "latitude": F.avg("latitude"),
        "longitude": F.avg("longitude"),
        "avg_temperature": F.avg("temperature"),
        "min_temperature": F.min("temperature"),
        "max_temperature": F.max("temperature"),
        **_alert_counts(),
        "total_messages": F.count(F.lit(1)),
    }
    return [measure.alias(name) for name, measure in measures.items()]


#: Fields of a flat reading that window metrics use.
USED = (
    "event_time", "latitude", "longitude", "city", "country", "temperature", "windspeed", "wind_alert_level",
    "heat_alert_level",
)


def window_metrics(
    readings: DataFrame,
    width: str = "5 minutes",
    slide: str | None = "1 minute",
    by: str = "location",
    lateness: str | None = None,
) -> DataFrame:
    """Temperature and alert metrics per location and window.

    ``slide=None`` gives tumbling windows. ``by="coordinates"`` keys on latitude and
    longitude alone. ``lateness`` sets the watermark on streams. Every measure has a
    partial form, so a location that sends most readings is combined before the shuffle.
    """
    timed = readings.withColumn("event_timestamp", event_timestamp(readings))
    if lateness:
        timed = timed.withWatermark("event_timestamp", lateness)
    if by == "location":
        keys = [location_key().alias("location"), F.col("city"), F.col("country")]
    elif by == "coordinates":
        keys = [coordinate_key().alias("location")]
    else:
        raise ValueError(f"unknown key {by!r}")
    span = F.window("event_timestamp", width, slide).alias("span")
    grouped = timed.groupBy(span, *keys).agg(*_metrics())
    return grouped.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *(c for c in grouped.columns if c != "span"),
    )


def metrics_of_state(state: DataFrame, by: str = "location") -> DataFrame:
    """Window metrics from the rows of the state data source, which hold the measures' buffers.

    The buffers are in the order of the measures: an average has a sum and a count.
    """
    names = ["location", "city", "country"] if by == "location" else ["location"]
    buffers: list[str] = []
    shown: list[Column] = []
    for name in ("latitude", "longitude", "avg_temperature"):
        buffers += [f"{name}_sum", f"{name}_n"]
        shown.append((F.col(f"{name}_sum") / F.nullif(f"{name}_n", F.lit(0))).alias(name))
    whole = ["min_temperature", "max_temperature", *_alert_counts(), "total_messages"]
    buffers += whole
    kinds = [field.dataType.simpleString() for field in state.schema["value"].dataType.fields]
    named = "struct<" + ",".join(f"{n}:{k}" for n, k in zip(buffers, kinds, strict=True)) + ">"
    keys = [field.dataType.simpleString() for field in state.schema["key"].dataType.fields]
    key = "struct<" + ",".join(f"{n}:{k}" for n, k in zip(["span", *names], keys, strict=True)) + ">"
    rows = state.select(F.col("key").cast(key).alias("key"), F.col("value").cast(named).alias("value")).select("key.*", "value.*")
    return rows.select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *names, *shown, *whole
    )


def stamp_computed(df: DataFrame) -> DataFrame:
    return df.withColumn("computed_at", F.current_timestamp())
