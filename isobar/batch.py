"""The batch jobs: from stored history to records and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isobar.operators import documents, profiles, records
from isobar.sinks.writers import publish_documents
from isobar.sources import documents as stored
from isobar.storage import materialise

Sink = tuple[str, str]


def _publish(built: DataFrame, base: str | None, kind: str, sink: Sink | None, by_year: bool, options: dict) -> None:
    # Stored and sent from one computation, so both outputs carry the same stamp.
    if base is not None and sink is not None:
        built = materialise(built, kind)
    publish_documents(built, documents.document_messages(built), base, kind, sink, by_year, **options)


def run_records(
    spark: SparkSession, source: str, base: str | None, sink: Sink | None = None, layout: str = "tree", **options: str
) -> None:
    """Extreme days of every city; ``base`` or ``sink`` left out skips that output."""
    found = records.climate_records(stored.daily_history(spark, source, layout))
    _publish(documents.record_documents(found), base, "records", sink, False, options)


def run_seasonal(
    spark: SparkSession, source: str, base: str | None, sink: Sink | None = None, layout: str = "tree", **options: str
) -> None:
    """Monthly climatology of every city, all years pooled."""
    profile = profiles.seasonal_profile(stored.daily_history(spark, source, layout))
    _publish(documents.seasonal_documents(profile), base, "seasonal", sink, False, options)


def run_enriched(
    spark: SparkSession,
    source: str,
    base: str | None,
    sink: Sink | None = None,
    layout: str = "tree",
    quantile_scope: str = "all",
    profile: DataFrame | None = None,
    **options: str,
) -> DataFrame:
    """Validated per-year profiles; returns how many city-years are complete.

    ``profile`` is one made from stored states, in place of one from history.
    """
    if profile is None:
        days = stored.daily_history(spark, source, layout)
        profile = profiles.full_profile(days, quantile_scope, unfold_once=layout != "rows")
    profile = materialise(profile, "profile")
    checked = profiles.completeness(profile)
    _publish(documents.enriched_documents(profile, checked), base, "enriched", sink, True, options)
    return profiles.completeness_summary(checked)


def reference_profile(spark: SparkSession, base: str, layout: str = "table", year: str = "earliest") -> DataFrame:
    """What the anomaly detector compares with, from stored enriched profiles."""
    return profiles.reference_profile(stored.enriched_profiles(spark, base, layout), year)
