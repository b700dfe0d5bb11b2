"""Readings compared with the month they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions import deviations
from isobar.functions.calendar import event_timestamp
from isobar.functions.deviations import SIGMA_LIMIT, TEMPERATURE_LIMIT
from isobar.functions.lookup import last_not_after
from isobar.functions.places import known

# Profile field -> its name beside a reading.
_EXPECTED = {
    "avg_temperature": "expected_temperature",
    "std_temperature": "temp_std",
    "temp_median": "temp_median",
    "avg_windspeed": "expected_windspeed",
    "std_windspeed": "wind_std",
    "wind_median": "wind_median",
    "alert_probability": "expected_alert_probability",
}


def _expected(prefix: str, there: list[str]) -> list[Column]:
    # A profile made without quartiles has no medians to carry along.
    absent = F.lit(None).cast("double")
    return [(F.col(prefix + name) if name in there else absent).alias(alias) for name, alias in _EXPECTED.items()]


def flag_anomalies(
    readings: DataFrame,
    profile: DataFrame,
    temp_threshold: float = TEMPERATURE_LIMIT,
    wind_threshold: float = SIGMA_LIMIT,
    temp_sigmas: float | None = None,
    profile_year: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Left-join readings with the reference profile of their city and month and flag them.

    ``wind_threshold`` is the number of standard deviations for wind, and for temperature
    too unless ``temp_sigmas`` is given. ``profile`` comes from reference_profile(), made with
    the same ``profile_year``: for "same" it holds one row per year and is matched on it,
    for "as-of" each reading is compared with its year's profile or, where there is none,
    with the nearest year before. Every reading gives one row, whatever the mode.
    Stateless, so it also runs on a stream.
    """
    if (profile_year == "as-of") != ("years" in profile.columns):
        raise ValueError('profiles by "as-of" and their profile_year go together')
    temp_sigmas = wind_threshold if temp_sigmas is None else temp_sigmas
    at = event_timestamp(readings)
    observed = readings.select(
        *carry,
        "event_time",
        "city",
        "country",
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.col("temperature").alias("observed_temperature"),
        F.col("windspeed").alias("observed_windspeed"),
        "wind_alert_level",
        "heat_alert_level",
    )
    keys = ["country", "city", "month", *(["year"] if profile_year == "same" else [])]
    if profile_year == "as-of":
        past = observed.join(profile.select(*keys, F.col("years").alias("_years")), keys, "left")
        past = past.withColumn("_past", last_not_after(F.col("_years"), F.col("year"), "year"))
        there = profile.schema["years"].dataType.elementType.fieldNames()
        matched = past.select(*observed.columns, *_expected("_past.", there))
    else:
        matched = observed.join(profile.select(*keys, *_expected("", profile.columns)), keys, "left")
    joined = matched.withColumns(
        {
            "temp_deviation": F.col("observed_temperature") - F.col("expected_temperature"),
            "wind_deviation": F.col("observed_windspeed") - F.col("expected_windspeed"),
        }
    )
    flagged = joined.withColumns(
        {
            "temp_abs_deviation": F.abs("temp_deviation"),
            "temp_anomaly": deviations.temperature_flag(
                F.col("temp_deviation"), F.col("temp_std"), temp_threshold, temp_sigmas
            ),
            "wind_anomaly": deviations.wind_flag(F.col("wind_deviation"), F.col("wind_std"), wind_threshold),
            "alert_anomaly": deviations.alert_flag(
                "wind_alert_level", "heat_alert_level", F.col("expected_alert_probability")
            ),
        }
    )
    flags = [F.col(name) for name in ("temp_anomaly", "wind_anomaly", "alert_anomaly")]
    return flagged.withColumns(
        {
            "is_anomaly": flags[0] | flags[1] | flags[2],
            "anomaly_type": deviations.anomaly_type(*flags, F.col("temp_deviation")),
        }
    )


def _message(variable: str, observed: Column, expected: str) -> Column:
    return F.struct(
        F.lit(variable).alias("variable"),
        observed.alias("observed_value"),
        F.col(expected).alias("expected_value"),
    )


def anomaly_messages(flags: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One message per flagged variable; all carry the reading's anomaly type.

    The messages of a reading are built in one array and unfolded, so the join behind
    ``flags`` is evaluated once rather than once per variable.
    """
    found = F.array(
        F.when(F.col("temp_anomaly"), _message("temperature", F.col("observed_temperature"), "expected_temperature")),
        F.when(F.col("wind_anomaly"), _message("windspeed", F.col("observed_windspeed"), "expected_windspeed")),
        F.when(F.col("alert_anomaly"), _message("alert", F.lit(1.0), "expected_alert_probability")),
    )
    unfolded = flags.where("is_anomaly").select(
        *carry,
        "event_time",
        "city",
        "country",
        "anomaly_type",
        F.inline(F.filter(found, lambda message: message.isNotNull())),
    )
    return unfolded.select(
        *carry, "event_time", "city", "country", "variable", "observed_value", "expected_value", "anomaly_type"
    )


def anomaly_type_counts(anomalies: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    kind = F.coalesce("anomaly_type", F.lit("unknown")).alias("anomaly_type")
    return anomalies.groupBy(*by, kind).agg(F.count(F.lit(1)).alias("anomalies"))


def archive_rows(flags: DataFrame, now: Column | None = None) -> DataFrame:
    """Anomalies as archived, placed by country, city, year and month.

    An anomaly whose event time cannot be read is filed under the current month.
    """
    now = F.current_timestamp() if now is None else now
    return flags.where("is_anomaly").select(
        F.col("event_time").cast("string").alias("event_time"),
        F.coalesce("anomaly_type", F.lit("unknown")).alias("anomaly_type"),
        "observed_temperature",
        "expected_temperature",
        "observed_windspeed",
        "expected_windspeed",
        "temp_deviation",
        "wind_deviation",
        known("country").alias("country"),
        known("city").alias("city"),
        F.coalesce("year", F.year(now)).alias("year"),
        F.coalesce("month", F.month(now)).alias("month"),
    )


def archive_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("country", "city", "year", "month").agg(F.count(F.lit(1)).alias("total_anomalies"))


def message_table(messages: DataFrame) -> DataFrame:
    """Messages as tables show them, with the deviation printed to two decimals.

    The number format rounds the exact binary value, as printf does; round() would
    round its shortest decimal text.
    """
    shown = F.expr("format_number(observed_value - expected_value, '0.00')")
    return messages.withColumn("deviation", shown.cast("double"))
