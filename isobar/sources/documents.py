"""Stored documents: history, alerts, records, profiles and anomalies.

``layout="tree"`` is one file per city under base/country/city/...; "table" is a
dataset folder partitioned by country_dir and city_dir, as this package writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isobar import schemas
from isobar.functions.places import safe_text
from isobar.operators.documents import unfold_enriched
from isobar.operators.history import unfold_history
from isobar.operators.serving import city_rows
from isobar.sinks.archive import read_archive
from isobar.sinks.daily_store import stored_days

# Where each kind of document lies below base/country/city.
TREE = {
    "history": "weather_history_raw/historical_data.json",
    "alerts": "alerts.json",
    "records": "weather_records/records.json",
    "seasonal": "seasonal_profile/seasonal_profile.json",
    "enriched": "seasonal_profile_enriched/*/profile.json",
    "anomalies": "anomalies/*/*/anomalies.json",
}


def _with_dirs(schema: StructType) -> StructType:
    # Named here so that a city called "007" is not read back as a number.
    named = StructType(list(schema.fields))
    for name in ("country_dir", "city_dir"):
        named = named.add(name, "string")
    return named


#: Country and city whose files alone are read.
Place = tuple[str, str]


def _literal(name: str) -> str:
    """A folder name as a path pattern that matches nothing else."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in safe_text(name))


def _read(
    spark: SparkSession, base: str, kind: str, schema: StructType, layout: str, place: Place | None = None
) -> DataFrame:
    if layout == "tree":
        multi_line = kind != "alerts"
        country, city = map(_literal, place) if place else ("*", "*")
        return spark.read.schema(schema).option("multiLine", multi_line).json(f"{base}/{country}/{city}/{TREE[kind]}")
    named = _with_dirs(schema)
    read = read_archive(spark, f"{base}/{kind}", named) if kind == "alerts" else spark.read.schema(named).json(f"{base}/{kind}")
    if place:
        country, city = map(safe_text, place)
        read = read.where((F.col("country_dir") == country) & (F.col("city_dir") == city))
    return read


#: Archives of micro-batches: their rows, and the columns that they are filed by.
ARCHIVES = {
    "alerts": (_with_dirs(schemas.ALERT_ENTRY), ["country_dir", "city_dir"]),
    "anomalies": (
        StructType(schemas.ANOMALY_ROW.fields + schemas.ANOMALY_PLACE.fields), schemas.ANOMALY_PLACE.fieldNames()
    ),
}


def stored_places(spark: SparkSession, base: str, kind: str = "history") -> DataFrame:
    """(country, city) folder names of a stored kind, from the names of its files alone."""
    # Named as text, so that a city called "007" stays what it is; no file is opened.
    named = _with_dirs(StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long").add("content", "binary"))
    files = spark.read.format("binaryFile").schema(named).option("pathGlobFilter", "*.json").load(f"{base}/{kind}")
    return files.select(F.col("country_dir").alias("country"), F.col("city_dir").alias("city")).distinct()


def history_documents(
    spark: SparkSession, base: str, layout: str = "tree", place: Place | None = None
) -> DataFrame:
    return _read(spark, base, "history", schemas.HISTORY_DOCUMENT, layout, place)


def daily_history(spark: SparkSession, base: str, layout: str = "tree", place: Place | None = None) -> DataFrame:
    """Daily observation rows; a file that is no JSON contributes none.

    ``layout="rows"`` reads the Parquet that store_daily() and merge_daily() wrote, of which
    only the needed columns and, for one city, only its files are read.
    """
    if layout == "rows":
        return stored_days(spark, base, place)
    return unfold_history(history_documents(spark, base, layout, place))


def enriched_profiles(
    spark: SparkSession, base: str, layout: str = "tree", place: Place | None = None
) -> DataFrame:
    """Monthly rows of all stored enriched profiles, or of one city's."""
    return unfold_enriched(_read(spark, base, "enriched", schemas.ENRICHED_DOCUMENT, layout, place))


def unfold_alerts(entries: DataFrame) -> DataFrame:
    """Alert rows of archive lines; lines without alert data are dropped."""
    kept = entries.where("alert_data is not null")
    dirs = [name for name in ("country_dir", "city_dir") if name in entries.columns]
    return kept.select("alert_data.*", F.coalesce("timestamp", F.lit("")).alias("saved_timestamp"), *dirs)


def archived_alerts(
    spark: SparkSession, base: str, layout: str = "table", place: Place | None = None
) -> DataFrame:
    return unfold_alerts(_read(spark, base, "alerts", schemas.ALERT_ENTRY, layout, place))


def archived_anomalies(
    spark: SparkSession, base: str, layout: str = "table", place: Place | None = None
) -> DataFrame:
    """Anomaly rows with country, city, year and month."""
    if layout == "tree":
        files = _read(spark, base, "anomalies", schemas.ANOMALY_FILE, layout, place)
        return files.select(*schemas.ANOMALY_PLACE.fieldNames(), F.inline("anomalies"))
    rows = read_archive(spark, f"{base}/anomalies", ARCHIVES["anomalies"][0])
    # This archive is partitioned by the names themselves.
    return city_rows(rows, *place) if place else rows


def stored(
    spark: SparkSession,
    base: str,
    kind: str,
    schema: StructType,
    layout: str = "table",
    place: Place | None = None,
) -> DataFrame:
    """Records or seasonal documents with the given schema."""
    return _read(spark, base, kind, schema, layout, place)
