"""Boundary tables for every rule on single values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from isobar.functions import calendar, codes, deviations, levels, places

# Golden cases: (scale, value, grade).
GRADES = [
    *((levels.LIVE_WIND, v, g) for v, g in [(9.99, 0), (10.0, 1), (20.0, 1), (20.01, 2), (-1.0, 0), (None, 0)]),
    *((levels.LIVE_HEAT, v, g) for v, g in [(24.99, 0), (25.0, 1), (35.0, 1), (35.01, 2), (None, 0)]),
    *((levels.DAILY_WIND, v, g) for v, g in [(9.99, 0), (10.0, 1), (19.99, 1), (20.0, 2), (None, 0)]),
    *((levels.DAILY_HEAT, v, g) for v, g in [(24.99, 0), (25.0, 1), (35.0, 1), (35.01, 2), (None, 0)]),
]


def one(spark, column, **values):
    kinds = {float: "double", int: "int", str: "string", bool: "boolean", type(None): "double"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in values.items()) or "_ int"
    row = tuple(values.values()) or (0,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first().out


def test_grades(spark):
    for scale in {scale for scale, _, _ in GRADES}:
        cases = [(value, grade) for other, value, grade in GRADES if other is scale]
        rows = spark.createDataFrame(cases, "v double, wanted int")
        graded = rows.select("wanted", scale.grade("v").alias("grade"), scale.level("v").alias("level"))
        for row in graded.collect():
            assert row.grade == row.wanted
            assert row.level == f"level_{row.wanted}"


def test_grades_on_random_values(spark):
    """Nulls, NaN, boundaries and their neighbours against the rule in plain Python."""
    pick = random.Random(5)
    around = [10.0, 20.0, 25.0, 35.0]
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0]
    values += [math.nextafter(b, pick.choice([-1e9, 1e9])) for b in around for _ in range(10)]
    values += around + [pick.uniform(-60, 60) for _ in range(300)]

    def expected(value):
        if value is None:
            return 0
        if math.isnan(value):
            return 2  # NaN sorts above every number
        return 2 if value > 20 else 1 if value >= 10 else 0

    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for row in rows.select("i", levels.LIVE_WIND.grade("v").alias("g")).collect():
        assert row.g == expected(values[row.i]), values[row.i]


def test_nan_can_be_treated_as_missing(spark):
    assert one(spark, levels.LIVE_WIND.level("v", nan_is_missing=True), v=math.nan) == "level_0"
    assert one(spark, levels.LIVE_WIND.level("v"), v=math.nan) == "level_2"


def test_worked_examples(spark):
    for heat, wind, wanted in [(20.5, 15.2, (0, 1)), (38.0, 25.5, (2, 2)), (28.0, 5.5, (1, 0))]:
        got = one(spark, F.array(levels.LIVE_HEAT.grade("t"), levels.LIVE_WIND.grade("w")), t=heat, w=wind)
        assert tuple(got) == wanted


@pytest.mark.parametrize(
    ("wind", "heat", "alert"),
    [("level_0", "level_0", False), ("level_1", "level_0", True), (None, "level_2", True), (None, None, False)],
)
def test_any_raised(spark, wind, heat, alert):
    rows = spark.createDataFrame([(wind, heat)], "wind_alert_level string, heat_alert_level string")
    assert rows.select(levels.any_raised().alias("a")).first().a is alert


def test_wind_units(spark):
    assert one(spark, levels.wind_in_ms("v", "km/h"), v=36.0) == pytest.approx(10.0)
    assert one(spark, levels.wind_in_ms("v"), v=36.0) == 36.0


@pytest.mark.parametrize(
    ("name", "safe"),
    [("New York", "New_York"), ("a/b", "a_b"), (None, "Unknown"), ("", "Unknown"), ("Rio / Sul", "Rio___Sul")],
)
def test_safe_name(spark, name, safe):
    rows = spark.createDataFrame([(name,)], "n string")
    assert rows.select(places.safe_name("n").alias("s")).first().s == safe


def test_location_key_and_archive_place(spark):
    rows = spark.createDataFrame(
        [
            ("France", "Paris", 48.5, 2.25),
            ("France", None, 48.5, 2.25),
            (None, None, None, 2.25),
            ("Unknown", "Paris", 1.0, 2.0),
        ],
        "country string, city string, latitude double, longitude double",
    )
    found = rows.withColumn("key", places.location_key()).withColumns(places.archive_place()).collect()
    assert [row.key for row in found] == ["France/Paris", "48.5,2.25", None, "Unknown/Paris"]
    assert [(row.archive_country, row.archive_city) for row in found] == [
        ("France", "Paris"), ("Lat_48.5", "Lon_2.25"), ("Lat_0", "Lon_2.25"), ("Lat_1.0", "Lon_2.0"),
    ]


@pytest.mark.parametrize(
    ("parts", "wanted"),
    [
        (("Paris", "Île-de-France", "France"), "Paris, Île-de-France, France"),
        (("Paris", None, "France"), "Paris, , France"),
        (("Paris", "IDF", None), "Paris, IDF"),
        (("Paris", None, None), "Paris"),
    ],
)
def test_full_place_name(spark, parts, wanted):
    rows = spark.createDataFrame([parts], "a string, b string, c string")
    assert rows.select(places.full_place_name("a", "b", "c").alias("n")).first().n == wanted


@pytest.mark.parametrize(
    ("latitude", "longitude", "valid"),
    [(90.0, 180.0, True), (-90.0, -180.0, True), (90.01, 0.0, False), (0.0, -180.5, False), (None, 0.0, False)],
)
def test_valid_coordinates(spark, latitude, longitude, valid):
    rows = spark.createDataFrame([(latitude, longitude)], "latitude double, longitude double")
    assert rows.select(places.valid_coordinates().alias("v")).first().v is valid


def test_months(spark):
    rows = spark.range(0, 14).select(F.col("id").cast("int").alias("m"))
    names = [row.n for row in rows.select(calendar.month_name("m").alias("n"), "m").orderBy("m").collect()]
    assert names[0] is None and names[13] is None
    assert names[1] == "Janvier" and names[8] == "Août" and names[12] == "Décembre"


def test_dates_from_text(spark):
    rows = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("soon",), (None,)], "date string")
    found = calendar.with_month_and_year(rows).collect()
    assert [(row.month, row.year) for row in found] == [(2, 2024), (None, None), (None, None), (None, None)]
    years = rows.select(calendar.year_of_text("date").alias("y")).collect()
    assert [row.y for row in years] == [2024, 2023, None, None]


def test_event_times_accept_fraction_and_zone(spark):
    texts = ["2024-01-12T10:30:00.123Z", "2024-01-12T10:30:00", "2024-01-12T12:30:00+02:00", "later", None]
    rows = spark.createDataFrame([(text,) for text in texts], "event_time string")
    at = rows.select(F.date_format(calendar.event_timestamp(rows), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [row.t for row in at] == ["2024-01-12 10:30:00"] * 3 + [None, None]


def test_weather_labels(spark):
    wanted = {0: "Ciel dégagé", 2: "Principalement dégagé, partiellement nuageux, couvert", 4: None, 48: "Brouillard",
              95: "Orage", 96: "Orage avec grêle", 100: None}
    rows = spark.createDataFrame([(code,) for code in wanted], "c int")
    found = {row.c: row.label for row in rows.select("c", codes.weather_label("c").alias("label")).collect()}
    assert found == wanted


def test_tukey_fences(spark):
    low, high = deviations.tukey_fences(F.col("a"), F.col("b"))
    assert one(spark, F.array(low, high), a=1.0, b=3.0) == [-2.0, 6.0]


def test_history_period(spark):
    until = F.lit("2024-03-01").cast("date")
    rows = spark.createDataFrame([("2023-03-01",), ("2023-03-02",), ("2024-03-01",), ("2024-03-02",)], "d string")
    inside = rows.where(calendar.within_years(F.col("d").cast("date"), 1, until)).collect()
    assert [row.d for row in inside] == ["2023-03-02", "2024-03-01"]
