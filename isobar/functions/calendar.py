"""Dates, event times and month names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

# Month names and short labels as stored and shown.
MONTH_NAMES = {
    "fr": (
        "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
        "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
    ),
    "fr-short": ("Jan", "Fév", "Mar", "Avr", "Mai", "Jun", "Jul", "Aoû", "Sep", "Oct", "Nov", "Déc"),
}


def month_name(month: Column | str, locale: str = "fr") -> Column:
    """Name of month 1..12; anything else gives null."""
    month = F.col(month) if isinstance(month, str) else month
    names = F.array(*(F.lit(name) for name in MONTH_NAMES[locale]))
    return F.get(names, month - 1)


def observation_date(df: DataFrame, column: str = "date") -> Column:
    """The observation date; text that is no yyyy-MM-dd date becomes null."""
    if isinstance(df.schema[column].dataType, DateType):
        return F.col(column)
    return F.try_to_date(F.col(column), "yyyy-MM-dd")


def with_month(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn("month", F.month(observation_date(df, column)))


def with_month_and_year(df: DataFrame, column: str = "date") -> DataFrame:
    return with_month(df, column).withColumn("year", F.year(observation_date(df, column)))


def year_of_text(date: Column | str) -> Column:
    """Year as written before the first dash of an ISO date text."""
    date = F.col(date) if isinstance(date, str) else date
    return F.split_part(date, F.lit("-"), F.lit(1)).try_cast("int")


def event_timestamp(df: DataFrame, column: str = "event_time") -> Column:
    """Event time as TIMESTAMP; ISO text with fraction and zone is accepted, junk is null."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")


def within_years(date: Column, years: int, until: Column | None = None) -> Column:
    """Dates of the download period: ``years`` times 365 days up to ``until`` (default today)."""
    until = F.current_date() if until is None else until
    return date.between(F.date_sub(until, years * 365), until)
