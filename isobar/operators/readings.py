"""From raw messages to graded flat readings and back to messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isobar import schemas
from isobar.functions.calendar import event_timestamp
from isobar.functions.levels import LIVE_HEAT, LIVE_WIND, any_raised, wind_in_ms
from isobar.functions.places import archive_place, location_key, safe_name, valid_coordinates

# Flat field -> where the nested reading keeps it.
_NESTED = {
    "latitude": "location.latitude",
    "longitude": "location.longitude",
    "city": "location.city",
    "country": "location.country",
    "location_name": "location.location_name",
    "temperature": "current_weather.temperature",
    "windspeed": "current_weather.windspeed",
    "winddirection": "current_weather.winddirection",
    "weathercode": "current_weather.weathercode",
    "weather_time": "current_weather.time",
    "original_timestamp": "timestamp",
    "data_source": "source",
}


def parse_messages(
    messages: DataFrame, schema: StructType, carry: Iterable[str] = (), fields: Iterable[str] | None = None
) -> DataFrame:
    """Decode JSON payloads; a payload that is no JSON keeps its row with null fields.

    ``carry`` names message columns (offset, partition, ...) to keep beside the fields.
    ``fields`` names the fields to parse, all by default; others are skipped in the text.
    The decoded struct is unfolded by a generator rather than by field access: filters
    on its fields then stay above the parsing, which would otherwise run once more for
    every filter.
    """
    wanted = schema if fields is None else StructType([schema[name] for name in fields])
    body = F.from_json(F.col("value").cast("string"), wanted)
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("timestamp").alias("received_at"),
        *carry,
        F.inline(F.array(body)),
    )


def grade_alerts(readings: DataFrame, wind_unit: str = "m/s", nan_is_missing: bool = False) -> DataFrame:
    """Add the live wind and heat alert levels."""
    return readings.withColumns(
        {
            "wind_alert_level": LIVE_WIND.level(wind_in_ms("windspeed", wind_unit), nan_is_missing),
            "heat_alert_level": LIVE_HEAT.level("temperature", nan_is_missing),
        }
    )


def flatten_readings(
    parsed: DataFrame,
    event_time: str = "processing",
    carry: Iterable[str] = (),
    wind_unit: str = "m/s",
    nan_is_missing: bool = False,
) -> DataFrame:
    """Flatten nested readings and grade them.

    ``event_time`` is "processing" (the moment the row is processed), "payload"
    (the reading's own timestamp) or "received" (the broker's timestamp).
    """
    stamps: dict[str, Column] = {
        "processing": F.current_timestamp(),
        "payload": F.try_to_timestamp(F.col("timestamp")),
        "received": F.col("received_at").cast("timestamp"),
    }
    flat = parsed.select(
        stamps[event_time].alias("event_time"),
        *(F.col(path).alias(name) for name, path in _NESTED.items()),
        "message_key",
        *carry,
    )
    return grade_alerts(flat, wind_unit, nan_is_missing)


def keyed_json(df: DataFrame, key: Column | str, fields: Iterable[str]) -> DataFrame:
    """(key, value) messages; null fields are left out of the JSON text."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def reading_messages(flat: DataFrame) -> DataFrame:
    return keyed_json(flat, "message_key", schemas.FLAT_READING.fieldNames())


def parse_flat_readings(
    messages: DataFrame, carry: Iterable[str] = (), fields: Iterable[str] | None = None
) -> DataFrame:
    return parse_messages(messages, schemas.FLAT_READING, carry, fields)


def classify_messages(messages: DataFrame, required: str = "current_weather") -> DataFrame:
    """Tag every message: reading, other_json (valid JSON without a reading) or text.

    Each payload is parsed once: in a projection of its own, and with the tag coming out
    of a generator, below which filters on it cannot be pushed.
    """
    decoded = messages.withColumn("_body", F.try_parse_json(F.col("value").cast("string")))
    reading = F.try_variant_get("_body", f"$.{required}", "variant")
    kind = F.when(F.col("_body").isNull(), "text").when(reading.isNull(), "other_json").otherwise("reading")
    return decoded.select(*messages.columns, F.explode(F.array(kind)).alias("kind"))


def split_valid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): JSON payloads go on, plain text is set aside."""
    tagged = classify_messages(messages)
    return tagged.where("kind <> 'text'"), tagged.where("kind = 'text'")


def reading_envelopes(responses: DataFrame, source: str, stamped_at: Column | None = None) -> DataFrame:
    """Wrap landed current-weather responses into keyed raw readings.

    Responses without current weather and with coordinates off the globe are dropped;
    unknown location fields are absent from the JSON.
    """
    stamped_at = F.current_timestamp() if stamped_at is None else stamped_at
    kept = responses.where(F.col("current_weather").isNotNull() & valid_coordinates())
    named = kept.withColumns({name: F.nullif(name, F.lit("")) for name in ("city", "country", "location_name")})
    envelope = F.struct(
        F.date_format(stamped_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(*schemas.LOCATION.fieldNames()).alias("location"),
        "current_weather",
        F.lit(source).alias("source"),
    )
    return named.select(location_key().alias("key"), F.to_json(envelope).alias("value"))


def stamp_received(messages: DataFrame) -> DataFrame:
    """Add when the row was received, and give rows without an event time that moment."""
    now = F.current_timestamp()
    event_time = F.coalesce(event_timestamp(messages), now)
    return messages.withColumns({"received_at": now, "shown_time": event_time})


def with_location_key(readings: DataFrame) -> DataFrame:
    return readings.withColumn("location_key", location_key())


def with_event_timestamp(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_timestamp", event_timestamp(readings))


def alerts(readings: DataFrame) -> DataFrame:
    """Readings with a wind or heat alert, placed in the archive's country and city."""
    return readings.where(any_raised()).withColumns(archive_place())


def severe_alerts(readings: DataFrame, kind: str) -> DataFrame:
    """Level 2 alerts of one kind, ``wind`` or ``heat``."""
    return readings.where(F.col(f"{kind}_alert_level") == "level_2")


def alert_entries(readings: DataFrame, saved_at: Column | None = None) -> DataFrame:
    """Archive lines {timestamp, alert_data} with their path-safe country_dir and city_dir."""
    saved_at = F.current_timestamp() if saved_at is None else saved_at
    fields = [name for name in schemas.FLAT_READING.fieldNames() if name in readings.columns]
    return alerts(readings).select(
        F.date_format(saved_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(*(F.col(f).cast(schemas.FLAT_READING[f].dataType).alias(f) for f in fields)).alias("alert_data"),
        safe_name("archive_country").alias("country_dir"),
        safe_name("archive_city").alias("city_dir"),
    )
