"""Queries that compare live readings with history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import anomalies, profiles, serving, summaries
from isobar.operators.windows import window_metrics
from isobar.plans.registry import query, second_text
from isobar.plans.views import FLAGS, MOVED_READINGS, flags, over
from isobar.sources import tables
from isobar.storage import materialise


def reference(spark: SparkSession, sf_dir: str, year: str = "earliest") -> DataFrame:
    """The stored reference profile, the product of a separate batch job."""
    profile = profiles.reference_profile(profiles.full_profile(tables.daily(spark, sf_dir)), year)
    return materialise(profile, "reference")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = tables.transformed(spark, sf_dir)
    return anomalies.flag_anomalies(live, reference(spark, sf_dir), carry=("reading_id",))


_FLAGS_SQL = """
select reading_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, city, country, year, month,
       observed_temperature, expected_temperature, temp_deviation, round(temp_std, 6) as temp_std, temp_median,
       observed_windspeed, expected_windspeed, wind_deviation, round(wind_std, 6) as wind_std, wind_median,
       expected_alert_probability, temp_anomaly, wind_anomaly, alert_anomaly, is_anomaly, anomaly_type
from flags"""


def _shown(flagged: DataFrame) -> DataFrame:
    return flagged.select(
        "reading_id", second_text("event_time"), "city", "country", "year", "month",
        "observed_temperature", "expected_temperature", "temp_deviation", F.round("temp_std", 6).alias("temp_std"),
        "temp_median", "observed_windspeed", "expected_windspeed", "wind_deviation",
        F.round("wind_std", 6).alias("wind_std"), "wind_median", "expected_alert_probability", "temp_anomaly", "wind_anomaly", "alert_anomaly", "is_anomaly", "anomaly_type",
    )


@query(over(FLAGS, _FLAGS_SQL))
def anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_flags(spark, sf_dir))


def _compared(spark: SparkSession, sf_dir: str, year: str) -> DataFrame:
    live = tables.moved_in_time(tables.transformed(spark, sf_dir))
    profile = reference(spark, sf_dir, year)
    return _shown(anomalies.flag_anomalies(live, profile, profile_year=year, carry=("reading_id",)))


@query(over(flags("latest", MOVED_READINGS), _FLAGS_SQL))
def anomaly_flags_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, "latest")


@query(over(flags("same", MOVED_READINGS), _FLAGS_SQL))
def anomaly_flags_same_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, "same")


@query(over(flags("as-of", MOVED_READINGS), _FLAGS_SQL))
def anomaly_flags_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, "as-of")


MESSAGE_COLUMNS = "city, country, variable, observed_value, expected_value, anomaly_type"


@query(
    over(
        FLAGS,
        f"""
select reading_id, {MESSAGE_COLUMNS}, cast(printf('%.2f', observed_value - expected_value) as double) as deviation
from messages""",
    )
)
def anomaly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = anomalies.anomaly_messages(_flags(spark, sf_dir), carry=("reading_id",))
    return anomalies.message_table(messages).drop("event_time")


@query(
    over(
        FLAGS, "select country, city, anomaly_type, count(*) as anomalies from flags where is_anomaly group by all"
    )
)
def anomaly_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _flags(spark, sf_dir).where("is_anomaly")
    return anomalies.anomaly_type_counts(found, ("country", "city"))


@query(over(FLAGS, "select anomaly_type, count(*) as anomalies from messages group by all"))
def anomaly_message_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.anomaly_type_counts(anomalies.anomaly_messages(_flags(spark, sf_dir)))


@query(
    over(
        FLAGS,
        """
select country, city, year, month, count(*) as total_anomalies from flags where is_anomaly group by all""",
    )
)
def anomaly_archive_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.archive_totals(anomalies.archive_rows(_flags(spark, sf_dir)))


@query(
    over(
        FLAGS,
        """
select reading_id, variable, anomaly_type from messages
order by event_time desc, reading_id desc, variable limit 50""",
    )
)
def latest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = anomalies.anomaly_messages(_flags(spark, sf_dir), carry=("reading_id",))
    order = [F.desc("event_time"), F.desc("reading_id"), F.asc("variable")]
    return serving.newest(messages, order, 50).select("reading_id", "variable", "anomaly_type")


@query(
    over(
        FLAGS,
        """
select dataset, total, least(total, 1000)::bigint as retained from (
  select 'weather_transformed' as dataset, count(*) as total from transformed
  union all select 'weather_anomalies', count(*) from messages
  union all select 'weather_aggregates', count(*) from (
    select distinct location_key, city, country, time_bucket(interval '5 minutes', event_time) from transformed))""",
    )
)
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.stream_totals(
        {
            "weather_transformed": tables.readings(spark, sf_dir),
            "weather_anomalies": anomalies.anomaly_messages(_flags(spark, sf_dir)),
            "weather_aggregates": window_metrics(tables.transformed(spark, sf_dir), "5 minutes", None),
        }
    )
