"""History documents: wrapping downloads and unfolding them into days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.calendar import year_of_text
from isobar.functions.places import UNKNOWN

# Daily column -> name of its array in a history document.
SERIES = {
    "temperature_max": "temperature_2m_max",
    "temperature_min": "temperature_2m_min",
    "temperature_mean": "temperature_2m_mean",
    "precipitation": "precipitation_sum",
    "windspeed_max": "windspeed_10m_max",
    "windspeed_mean": "windspeed_10m_mean",
}

HISTORY_SOURCE = "open-meteo-archive"


def unfold_history(documents: DataFrame) -> DataFrame:
    """Daily rows of history documents.

    The parallel arrays are zipped by position; a shorter array gives nulls at its end,
    days without a date are dropped, and an unnamed place is Unknown at 0, 0. A document
    without dates zips to null and unfolds to no rows; testing for it up front would be
    pushed below the JSON parsing and parse every document twice.
    """
    series = F.arrays_zip(
        F.col("data.daily.time").alias("date"),
        *(
            F.coalesce(F.col(f"data.daily.{array}"), F.array().cast("array<double>")).alias(name)
            for name, array in SERIES.items()
        ),
    )
    place = {
        "city": F.lit(UNKNOWN),
        "country": F.lit(UNKNOWN),
        "latitude": F.lit(0.0),
        "longitude": F.lit(0.0),
    }
    days = documents.select(
        *(F.coalesce(F.col(f"metadata.location.{name}"), default).alias(name) for name, default in place.items()),
        F.explode(series).alias("day"),
    )
    dated = days.where("day.date is not null and day.date <> ''")
    return dated.select(
        "day.date", year_of_text("day.date").alias("year"), *place, *(f"day.{name}" for name in SERIES)
    )


def wrap_history(responses: DataFrame, years: int, until: Column | None = None, now: Column | None = None) -> DataFrame:
    """History documents from landed archive responses.

    ``responses`` has latitude, longitude, city, country, location_name and the
    ``daily`` struct of arrays; nothing is grouped, every response is one document.
    """
    until = F.current_date() if until is None else until
    now = F.current_timestamp() if now is None else now
    location = F.struct("latitude", "longitude", "city", "country", "location_name")
    period = F.struct(
        F.date_sub(until, years * 365).cast("string").alias("start_date"),
        until.cast("string").alias("end_date"),
        F.lit(years).alias("years"),
    )
    return responses.select(
        F.struct(
            location.alias("location"),
            period.alias("period"),
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("downloaded_at"),
            F.lit(HISTORY_SOURCE).alias("source"),
        ).alias("metadata"),
        F.struct("daily").alias("data"),
    )


def history_messages(documents: DataFrame) -> DataFrame:
    """Each document as one message; an unnamed city is keyed by its coordinates."""
    place = F.col("metadata.location")
    by_name = F.concat(place.country, F.lit("/"), F.nullif(place.city, F.lit(UNKNOWN)))
    by_point = F.concat(place.latitude.cast("string"), F.lit(","), place.longitude.cast("string"))
    return documents.select(
        F.coalesce(by_name, by_point).alias("key"), F.to_json(F.struct("metadata", "data")).alias("value")
    )
