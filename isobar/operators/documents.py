"""Nested documents per city as they are stored and sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isobar.functions.calendar import month_name
from isobar.functions.places import known, location_key, safe_name
from isobar.operators.profiles import CITY_YEAR, PLACE
from isobar.schemas import ENRICHED_MONTH, SEASONAL_MONTH, VALIDATION

# Origin tags written into the documents.
SEASONAL_SOURCE = "spark-seasonal-analyzer"
ENRICHED_SOURCE = "spark-seasonal-enricher"

_SEASONAL_MONTH = SEASONAL_MONTH.fieldNames()
_ENRICHED_MONTH = ENRICHED_MONTH.fieldNames()


def _place_fields() -> list[Column]:
    return [
        known("city").alias("city"),
        known("country").alias("country"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
    ]


def _iso_now(now: Column | None) -> Column:
    now = F.current_timestamp() if now is None else now
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _months(profile: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Monthly rows nested and sorted by month: at most twelve per document."""
    named = profile.where("month between 1 and 12").withColumn("month_name", month_name("month"))
    nested = F.array_sort(F.collect_list(F.struct(*fields)))
    return named.groupBy(*keys).agg(nested.alias("monthly_profiles"))


def record_documents(records: DataFrame, now: Column | None = None) -> DataFrame:
    def day(date: str, value: str, name: str) -> Column:
        return F.struct(F.col(date).cast("string").alias("date"), F.col(value).alias(name))

    return records.select(
        *_place_fields(),
        F.struct(
            day("max_temp_date", "max_temperature", "temperature").alias("hottest_day"),
            day("min_temp_date", "min_temperature", "temperature").alias("coldest_day"),
            day("max_wind_date", "max_windspeed", "windspeed").alias("strongest_wind"),
            day("max_precip_date", "max_precipitation", "precipitation").alias("rainiest_day"),
        ).alias("records"),
        F.struct(F.coalesce("total_days", F.lit(0)).alias("total_days")).alias("statistics"),
        _iso_now(now).alias("computed_at"),
    )


def seasonal_documents(profile: DataFrame, now: Column | None = None) -> DataFrame:
    nested = _months(profile, PLACE, _SEASONAL_MONTH)
    return nested.select(
        *_place_fields(), "monthly_profiles", _iso_now(now).alias("computed_at"), F.lit(SEASONAL_SOURCE).alias("source")
    )


def enriched_documents(profile: DataFrame, checked: DataFrame, now: Column | None = None) -> DataFrame:
    """One document per place and year with its completeness and status.

    Keys compare null-safely: a profile of unnamed places still gets its validation.
    """
    nested = _months(profile, [*PLACE, "year"], _ENRICHED_MONTH).alias("p")
    validation = checked.select(*CITY_YEAR, F.struct(*VALIDATION.fieldNames()).alias("validation")).alias("v")
    same = [F.col(f"p.{key}").eqNullSafe(F.col(f"v.{key}")) for key in CITY_YEAR]
    joined = nested.join(validation, same, "left").select("p.*", "v.validation")
    complete = F.coalesce(F.col("validation.is_complete"), F.lit(False))
    return joined.select(
        *_place_fields(),
        "year",
        "monthly_profiles",
        "validation",
        _iso_now(now).alias("computed_at"),
        F.lit(ENRICHED_SOURCE).alias("source"),
        F.when(complete, "complete").otherwise("incomplete").alias("validation_status"),
    )


def unfold_enriched(documents: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Monthly profile rows of enriched documents; months without a number are dropped.

    ``carry`` names document fields to repeat on every row.
    """
    months = documents.select(
        *carry,
        known("country").alias("country"),
        known("city").alias("city"),
        "year",
        "latitude",
        "longitude",
        F.explode("monthly_profiles").alias("m"),
    )
    kept = months.where("m.month is not null and m.month <> 0")
    place = ("country", "city", "year", "latitude", "longitude")
    return kept.select(*carry, *place, "m.*").withColumn(
        "alert_probability", F.coalesce("alert_probability", F.lit(0.0))
    )


def place_for_storage(documents: DataFrame) -> DataFrame:
    """Add the path-safe partition columns ``country_dir`` and ``city_dir``."""
    return documents.withColumns({"country_dir": safe_name("country"), "city_dir": safe_name("city")})


def document_messages(documents: DataFrame) -> DataFrame:
    """Each document as one (key, value) message keyed country/city."""
    fields = [name for name in documents.columns if name not in ("country_dir", "city_dir")]
    return documents.select(location_key().alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def read_as(documents: DataFrame, schema: StructType) -> DataFrame:
    """Documents from (key, value) messages."""
    return documents.select(F.from_json("value", schema).alias("body")).select("body.*")
