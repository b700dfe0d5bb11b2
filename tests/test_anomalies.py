"""Anomaly rules on the golden cases."""

import pytest
from pyspark.sql import functions as F

from isobar.functions.lookup import last_not_after
from isobar.operators import anomalies, profiles

READING = (
    "case int, event_time string, city string, country string, temperature double, windspeed double, "
    "wind_alert_level string, heat_alert_level string"
)
PROFILE = (
    "country string, city string, month int, avg_temperature double, std_temperature double, temp_median double, "
    "avg_windspeed double, std_windspeed double, wind_median double, alert_probability double"
)
AT = "2024-01-15T12:00:00.000Z"

# (temperature, wind, heat level) against (avg, std of temperature, avg, std of wind, probability)
CASES = {
    1: ((35.0, 8.0, "level_0"), (5.0, 3.0, 8.0, 4.0, 50.0), "heat_wave", ["temperature"]),
    2: ((5.0, 25.0, "level_0"), (5.0, 3.0, 8.0, 4.0, 50.0), "wind_storm", ["windspeed"]),
    3: ((5.0, 8.0, "level_2"), (5.0, 3.0, 8.0, 4.0, 2.0), "unexpected_alert", ["alert"]),
    4: ((10.0, 8.0, "level_0"), (5.0, 3.0, 8.0, 4.0, 50.0), "normal", []),
    5: ((1.0, 8.0, "level_0"), (5.0, 1.0, 8.0, 4.0, 50.0), "cold_spell", ["temperature"]),
    6: ((1.0, 8.0, "level_0"), (5.0, None, 8.0, 4.0, 50.0), "normal", []),
    7: ((5.0, -12.0, "level_0"), (5.0, 3.0, 8.0, 1.0, 50.0), "normal", []),
    8: ((5.0, 8.0, "level_1"), (5.0, 3.0, 8.0, 4.0, 10.0), "normal", []),
    9: ((15.0, 18.0, "level_0"), (5.0, 1.0, 8.0, 1.0, 50.0), "heat_wave", ["temperature", "windspeed"]),
    10: ((15.0, 18.0, "level_2"), None, "normal", []),
}


def flags_of(spark, case, **options):
    (temperature, wind, heat), profile, _, _ = CASES[case]
    reading = spark.createDataFrame([(case, AT, "Paris", "France", temperature, wind, "level_0", heat)], READING)
    rows = []
    if profile:
        avg_t, std_t, avg_w, std_w, probability = profile
        rows = [("France", "Paris", 1, avg_t, std_t, avg_t, avg_w, std_w, avg_w, probability)]
    return anomalies.flag_anomalies(reading, spark.createDataFrame(rows, PROFILE), carry=("case",), **options)


@pytest.mark.parametrize("case", CASES)
def test_golden_cases(spark, case):
    flags = flags_of(spark, case)
    row = flags.first()
    _, _, kind, variables = CASES[case]
    assert row.anomaly_type == kind
    assert row.is_anomaly is bool(variables)
    messages = anomalies.anomaly_messages(flags).collect()
    assert [m.variable for m in messages] == variables
    assert {m.anomaly_type for m in messages} <= {kind}


def test_alert_message_values(spark):
    message = anomalies.anomaly_messages(flags_of(spark, 3)).first()
    assert (message.observed_value, message.expected_value) == (1.0, 2.0)


def test_thresholds_can_be_changed(spark):
    assert flags_of(spark, 4, temp_threshold=4.0).first().anomaly_type == "heat_wave"
    assert flags_of(spark, 5, temp_sigmas=10.0).first().anomaly_type == "normal"
    assert flags_of(spark, 2, wind_threshold=10.0).first().anomaly_type == "normal"


def test_readings_without_place_or_time_survive(spark):
    rows = [(1, AT, None, "France", 50.0, 5.0, "level_0", "level_2"), (2, None, "Paris", "France", 50.0, 5.0, None, None)]
    readings = spark.createDataFrame(rows, READING)
    profile = spark.createDataFrame([("France", "Paris", 1, 5.0, 1.0, 5.0, 5.0, 1.0, 5.0, 0.0)], PROFILE)
    found = anomalies.flag_anomalies(readings, profile, carry=("case",)).collect()
    assert {(row.case, row.is_anomaly, row.expected_temperature) for row in found} == {(1, False, None), (2, False, None)}


def test_profile_of_the_same_year(spark):
    profile = spark.createDataFrame(
        [("France", "Paris", 1, 2023, 5.0), ("France", "Paris", 1, 2024, 34.0)],
        "country string, city string, month int, year int, avg_temperature double",
    )
    for name in ("std_temperature", "avg_windspeed", "std_windspeed", "alert_probability"):
        profile = profile.selectExpr("*", f"cast(null as double) as {name}")
    reading = spark.createDataFrame([(1, AT, "Paris", "France", 35.0, 5.0, "level_0", "level_0")], READING)
    found = anomalies.flag_anomalies(reading, profile, profile_year="same").collect()
    assert [row.expected_temperature for row in found] == [34.0]


def test_archive_rows_without_time_use_the_current_month(spark):
    flags = spark.createDataFrame(
        [(None, None, None, "x", True)], "country string, year int, month int, anomaly_type string, is_anomaly boolean"
    )
    for name in (
        "event_time", "city", "observed_temperature", "expected_temperature", "observed_windspeed",
        "expected_windspeed", "temp_deviation", "wind_deviation",
    ):
        flags = flags.selectExpr("*", f"cast(null as double) as {name}")
    flags = flags.withColumn("city", flags.city.cast("string"))
    row = anomalies.archive_rows(flags).first()
    assert (row.country, row.city) == ("Unknown", "Unknown")
    assert row.year >= 2024 and 1 <= row.month <= 12


def test_deviation_prints_like_printf(spark):
    messages = spark.createDataFrame([(7.5, 2.775), (35.0, 5.0)], "observed_value double, expected_value double")
    shown = [row.deviation for row in anomalies.message_table(messages).collect()]
    assert shown == [float(f"{7.5 - 2.775:.2f}"), 30.0]


def test_type_counts_name_the_unknown(spark):
    rows = spark.createDataFrame([("heat_wave",), (None,), ("heat_wave",)], "anomaly_type string")
    counted = {row.anomaly_type: row.anomalies for row in anomalies.anomaly_type_counts(rows).collect()}
    assert counted == {"heat_wave": 2, "unknown": 1}


YEARS = [(1995, 5.0), (1997, 7.0), (1998, 8.0), (2003, 13.0)]


def yearly_profile(spark, mode):
    """Two places of one city, so that a year has two profiles, of which the first place's counts."""
    rows = [("France", "Paris", lat, 2.0, year, 1, t + lat, 1.0, 1.0, 1.0, 50.0) for year, t in YEARS for lat in (0.0, 9.0)]
    rows += [("France", "Paris", 0.0, 2.0, 1996, 2, 99.0, 1.0, 1.0, 1.0, 50.0), ("France", "Paris", 0.0, 2.0, None, 1, 77.0, 1.0, 1.0, 1.0, 50.0)]
    fields = "country string, city string, latitude double, longitude double, year int, month int, avg_temperature double, "
    fields += "std_temperature double, avg_windspeed double, std_windspeed double, alert_probability double"
    return profiles.reference_profile(spark.createDataFrame(rows, fields).where("year is not null or '%s' = 'as-of'" % mode), mode)


@pytest.mark.parametrize("mode", profiles.PROFILE_YEARS)
def test_profile_years(spark, mode):
    """Each reading gives one row, compared with the year that the mode names."""
    asked = [1990, 1994, 1995, 1996, 1997, 2000, 2002, 2003, 2024, None]
    rows = [(y or 0, y and f"{y}-01-15T12:00:00Z", "Paris", "France", 6.0, 5.0, "level_0", "level_0") for y in asked]
    rows.append((1, "1997-01-15T12:00:00Z", "Lyon", "France", 6.0, 5.0, "level_0", "level_0"))
    readings = spark.createDataFrame(rows, READING)
    flags = anomalies.flag_anomalies(readings, yearly_profile(spark, mode), profile_year=mode, carry=("case",)).collect()
    assert len(flags) == len(rows)
    found = {row.case: row.expected_temperature for row in flags}
    known = dict(YEARS)
    wanted = {
        "earliest": lambda y: 5.0, "latest": lambda y: 13.0, "same": known.get,
        "as-of": lambda y: next((t for k, t in reversed(YEARS) if k <= y), None),
    }[mode]
    assert found == {y or 0: wanted(y) if y else None for y in asked} | {1: None}


def test_as_of_profiles_are_not_joined_as_others(spark):
    readings = spark.createDataFrame([], READING)
    with pytest.raises(ValueError, match="as-of"):
        anomalies.flag_anomalies(readings, yearly_profile(spark, "as-of"))
    with pytest.raises(ValueError, match="as-of"):
        anomalies.flag_anomalies(readings, yearly_profile(spark, "same"), profile_year="as-of")


def test_last_not_after(spark):
    """Halving finds what a scan of the array finds, at all sizes."""
    rows = [(n, at) for n in range(0, 70) for at in (-1, 0, 1, n - 1, 2 * n, 2 * n + 5, None)] + [(None, 3)]
    made = spark.createDataFrame(rows, "n int, at int").withColumn(
        "entries", F.expr("if(n is null, null, if(n = 0, array(), transform(sequence(1, n), i -> named_struct('key', 2 * i))))")
    ).withColumn("entries", F.col("entries").cast("array<struct<key:int>>"))
    found = made.select("n", "at", last_not_after(F.col("entries"), F.col("at"), "key")["key"].alias("key")).collect()
    for row in found:
        fits = [2 * i for i in range(1, (row.n or 0) + 1) if row.at is not None and 2 * i <= row.at]
        assert row.key == (fits[-1] if fits else None)
