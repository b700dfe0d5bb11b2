"""Records, profiles, completeness, documents and thinned series on small fixtures."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import documents, history, ordinals, profiles, records, serving

DAILY = (
    "date string, year int, country string, city string, latitude double, longitude double, temperature_mean double, "
    "temperature_max double, temperature_min double, windspeed_mean double, windspeed_max double, precipitation double"
)


def day(date, mean=10.0, top=None, low=None, wind=5.0, gust=8.0, rain=1.0, city="Paris", country="France"):
    top = mean if top is None else top
    low = mean if low is None else low
    year = int(date[:4]) if date else None
    return (date, year, country, city, 48.5, 2.25, mean, top, low, wind, gust, rain)


def daily(spark, *rows):
    return spark.createDataFrame(list(rows), DAILY)


def test_record_ties_go_to_the_latest_day(spark):
    found = records.climate_records(
        daily(
            spark,
            day("2020-01-01", top=30.0, low=-5.0, gust=9.0, rain=4.0),
            day("2020-06-01", top=30.0, low=-5.0, gust=12.0, rain=0.0),
            day("2020-03-01", top=29.0, low=0.0, gust=11.0, rain=4.0),
            day("2021-01-01", top=99.0, gust=None),
        )
    ).first()
    assert (found.max_temp_date, found.max_temperature) == ("2020-06-01", 30.0)
    assert (found.min_temp_date, found.min_temperature) == ("2020-06-01", -5.0)
    assert (found.max_wind_date, found.max_windspeed) == ("2020-06-01", 12.0)
    assert (found.max_precip_date, found.max_precipitation) == ("2020-03-01", 4.0)
    assert found.total_days == 3


def test_records_equal_ranked_rows(spark):
    """The one-pass records against ranking every city four times."""
    pick = random.Random(3)
    rows = [
        day(f"2020-{pick.randint(1, 12):02d}-{pick.randint(1, 28):02d}", mean=10.0, top=float(pick.randint(0, 5)),
            low=float(pick.randint(-5, 0)), gust=float(pick.randint(0, 4)), rain=float(pick.randint(0, 3)),
            city=f"C{pick.randint(0, 4)}")
        for _ in range(400)
    ]
    df = daily(spark, *rows)
    found = {row.city: row for row in records.climate_records(df).collect()}
    for column, date, order in [
        ("temperature_max", "max_temp_date", F.desc("temperature_max")),
        ("temperature_min", "min_temp_date", F.asc("temperature_min")),
        ("windspeed_max", "max_wind_date", F.desc("windspeed_max")),
        ("precipitation", "max_precip_date", F.desc("precipitation")),
    ]:
        first = records.top_k_per_group(df, ["country", "city"], [order, F.desc("date")], 1)
        assert {row.city: row.date for row in first.collect()} == {c: row[date] for c, row in found.items()}, column


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({"mean": -50.0}, True), ({"mean": 60.0}, True), ({"mean": -50.01}, False), ({"mean": 60.01}, False),
        ({"gust": 0.0}, True), ({"gust": 60.0}, True), ({"gust": 60.01}, False), ({"gust": -0.01}, False),
        ({"gust": None}, False), ({"wind": 60.01}, False), ({"wind": None}, False), ({"mean": None}, False),
    ],
)
def test_physical_ranges(spark, change, kept):
    values = {"top": 1.0, "low": 1.0, **change}
    assert profiles.validated_days(daily(spark, day("2020-01-01", **values))).count() == int(kept)


def test_rejects_are_counted_by_rule(spark):
    counted = profiles.range_rejects(
        daily(spark, day("2020-01-01"), day("2020-01-02", gust=61.0, mean=70.0), day("2020-01-03", gust=None))
    )
    days = {row.rule: row.days for row in counted.collect()}
    assert days["windspeed_max above 60"] == 1
    assert days["temperature_mean above 60"] == 1
    assert days["missing windspeed_max"] == 1
    assert days["any rule"] == 2
    assert days["missing date"] == 0


def test_profile_measures(spark):
    df = daily(
        spark,
        day("2020-01-01", mean=0.0, top=36.0, gust=20.0, rain=0.0),
        day("2020-01-02", mean=4.0, top=25.0, gust=10.0, rain=2.0),
        day("2021-01-03", mean=8.0, top=10.0, gust=5.0, rain=4.0),
    )
    pooled = profiles.seasonal_profile(df).first()
    assert (pooled.month, pooled.total_days, pooled.days_with_alert) == (1, 3, 2)
    assert pooled.alert_probability == pytest.approx(200 / 3)
    assert (pooled.wind_level_1_days, pooled.wind_level_2_days) == (1, 1)
    assert (pooled.heat_level_1_days, pooled.heat_level_2_days) == (1, 1)
    assert pooled.total_precipitation == 6.0
    yearly = {row.year: row for row in profiles.enriched_profile(df).collect()}
    assert yearly[2020].std_temperature == pytest.approx(statistics.stdev([0.0, 4.0]))
    assert yearly[2021].std_temperature is None
    assert (yearly[2020].min_temperature, yearly[2020].max_temperature_max) == (0.0, 36.0)


def test_quartiles_are_nearest_ranks(spark):
    df = daily(spark, *(day(f"2020-01-0{i}", mean=float(i)) for i in (4, 2, 3, 1)))
    found = profiles.quartiles(df).first()
    assert (found.temp_q25, found.temp_median, found.temp_q75) == (1.0, 2.0, 3.0)


def test_quantile_scope(spark):
    """Quartiles see days the range check rejects, unless told otherwise."""
    df = daily(spark, day("2020-01-01", mean=1.0), day("2020-01-02", mean=2.0, gust=99.0))
    everything = profiles.full_profile(df).first()
    assert (everything.total_days, everything.temp_q75) == (1, 2.0)
    assert profiles.full_profile(df, "validated").first().temp_q75 == 1.0


def test_completeness(spark):
    df = daily(
        spark,
        *(day(f"2020-{month:02d}-01") for month in (1, 2, 12)),
        *(day(f"2021-{month:02d}-01") for month in range(1, 13)),
    )
    checked = profiles.completeness(profiles.enriched_profile(df))
    found = {row.year: row for row in checked.collect()}
    assert (found[2020].months_count, found[2020].is_complete) == (3, False)
    assert found[2020].missing_months == [3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert (found[2021].months_count, found[2021].missing_months, found[2021].is_complete) == (12, [], True)
    assert {row.is_complete: row.city_years for row in profiles.completeness_summary(checked).collect()} == {
        True: 1, False: 1,
    }


def test_extreme_months_prefer_the_earlier_month(spark):
    rows = [("F", "P", 1, 5.0, 2.0), ("F", "P", 2, 9.0, 7.0), ("F", "P", 3, 9.0, 7.0), ("F", "P", 4, 5.0, 1.0)]
    profile = spark.createDataFrame(
        rows, "country string, city string, month int, avg_temperature double, avg_windspeed double"
    )
    found = profiles.extreme_months(profile, ["country", "city"]).first()
    assert (found.hottest_month, found.coldest_month, found.windiest_month) == (2, 1, 2)
    assert (found.hottest_month_name, found.coldest_month_name) == ("Fév", "Jan")


@pytest.mark.parametrize(("year", "wanted"), [("earliest", [2019]), ("latest", [2021]), ("same", [2019, 2021])])
def test_reference_profile_year(spark, year, wanted):
    rows = [("F", "P", y, 1, 0.0, 0.0, float(y), None) for y in (2021, 2019)]
    profile = spark.createDataFrame(
        rows,
        "country string, city string, year int, month int, latitude double, longitude double, avg_temperature double, "
        "alert_probability double",
    )
    picked = profiles.reference_profile(profile, year).orderBy("year").collect()
    assert [row.year for row in picked] == wanted
    assert all(row.alert_probability == 0.0 for row in picked)


def test_iqr_outliers(spark):
    rows = [day(f"2020-01-{i:02d}", mean=float(10 + i % 3)) for i in range(1, 13)]
    df = daily(spark, *rows, day("2020-01-20", mean=40.0), day("2020-01-21", mean=-40.0))
    outliers = profiles.iqr_outliers(df, profiles.quartiles(df))
    assert {(row.date, row.temp_side) for row in outliers.collect()} == {("2020-01-20", "high"), ("2020-01-21", "low")}


def document(spark, text):
    return spark.createDataFrame([(text,)], "value string").select(
        F.from_json("value", schemas.HISTORY_DOCUMENT).alias("d")
    ).select("d.*")


def test_history_arrays_are_padded_and_undated_days_dropped(spark):
    text = """{"metadata": {"location": {"latitude": 48.5, "country": "France"}},
               "data": {"daily": {"time": ["2020-01-01", "2020-01-02", null, ""],
                                  "temperature_2m_max": [1.0], "windspeed_10m_mean": [2, 3, 4, 5, 6]}}}"""
    found = history.unfold_history(document(spark, text)).orderBy("date").collect()
    assert [(row.date, row.temperature_max, row.windspeed_mean) for row in found] == [
        ("2020-01-01", 1.0, 2.0), ("2020-01-02", None, 3.0),
    ]
    assert (found[0].city, found[0].country, found[0].latitude, found[0].longitude) == ("Unknown", "France", 48.5, 0.0)
    assert found[0].year == 2020


@pytest.mark.parametrize("text", ["not json", "{}", '{"data": {"daily": {}}}', '{"data": {"daily": {"time": []}}}'])
def test_documents_without_days_give_no_rows(spark, text):
    assert history.unfold_history(document(spark, text)).count() == 0


def test_documents_keep_zeros_and_sort_months(spark):
    df = daily(
        spark, *(day(f"2020-{month:02d}-{d:02d}", mean=0.0, rain=0.0, gust=0.0) for month in (3, 1) for d in (1, 2))
    )
    profile = profiles.full_profile(df)
    stored = documents.enriched_documents(profile, profiles.completeness(profile)).first()
    assert [m.month for m in stored.monthly_profiles] == [1, 3]
    first = stored.monthly_profiles[0]
    assert (first.month_name, first.avg_temperature, first.std_temperature) == ("Janvier", 0.0, 0.0)
    assert stored.validation_status == "incomplete"
    assert stored.validation.missing_months == [2, 4, 5, 6, 7, 8, 9, 10, 11, 12]


def test_unnamed_places_get_their_validation(spark):
    df = daily(spark, *(day(f"2020-{month:02d}-01", city=None) for month in range(1, 13)))
    profile = profiles.enriched_profile(df)
    full = profile.join(profiles.quartiles(df).drop("country", "city"), ["year", "month"])
    stored = documents.enriched_documents(full, profiles.completeness(full)).first()
    assert (stored.city, stored.validation_status) == ("Unknown", "complete")


def test_record_document_shape(spark):
    found = records.climate_records(daily(spark, day("2020-01-01", top=31.0)))
    built = documents.record_documents(found)
    assert {field.name for field in built.schema} == set(schemas.RECORD_DOCUMENT.fieldNames())
    row = built.first()
    assert row.records.hottest_day.asDict() == {"date": "2020-01-01", "temperature": 31.0}
    assert row.statistics.total_days == 1
    back = documents.read_as(documents.document_messages(built), schemas.RECORD_DOCUMENT).first()
    assert back.records == row.records


def series(spark, sizes, seed=1):
    pick = random.Random(seed)
    rows = [
        (city, f"2020-01-{pick.randint(1, 9):02d}", pick.randint(0, 3), pick.choice([None, 1.5, 2.5]))
        for city, size in sizes.items()
        for _ in range(size)
    ]
    pick.shuffle(rows)
    return rows, spark.createDataFrame(rows, "city string, date string, a int, b double").repartition(5)


def thinned_by_hand(rows, points):
    def sortable(row):
        return tuple((value is not None, value) for value in row[1:])

    kept = []
    for city in {row[0] for row in rows}:
        ordered = sorted((row for row in rows if row[0] == city), key=sortable)
        step = max(1, len(ordered) // points)
        kept += ordered[::step]
    return kept


def test_thin_series_equals_brute_force(spark):
    rows, df = series(spark, {"hot": 900, "mid": 70, "few": 5, None: 33})
    thinned = serving.thin_series(df, ["city"], ["date", "a", "b"], points=20)
    wanted = sorted(thinned_by_hand(rows, 20), key=str)
    assert sorted((tuple(row) for row in thinned.collect()), key=str) == wanted


def test_ten_years_thin_to_1217_days(spark):
    days = spark.range(3650).select(
        F.lit("Paris").alias("city"), F.date_add(F.lit("2014-01-01").cast("date"), F.col("id").cast("int")).alias("date")
    )
    assert serving.thin_series(days, ["city"], ["date"]).count() == 1217


def test_ordinals_number_copies_and_null_groups(spark):
    rows = [("a", 1)] * 300 + [("a", 2)] * 50 + [(None, 9), (None, 8), ("b", 5)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    numbered = ordinals.ordinal_in_group(df, ["k"], ["v"]).collect()
    by_group = {}
    for row in numbered:
        by_group.setdefault(row.k, []).append((row.ordinal, row.v))
        assert row.group_rows == {"a": 350, None: 2, "b": 1}[row.k]
    for key, positions in by_group.items():
        positions.sort()
        assert [p for p, _ in positions] == list(range(len(positions))), key
        values = [v for _, v in positions]
        assert values == sorted(values)


def test_latest_year(spark):
    rows = [("F", "P", 2019, 1), ("F", "P", 2021, 2), ("F", "L", 2020, 3)]
    df = spark.createDataFrame(rows, "country string, city string, year int, month int")
    assert {row.month for row in serving.latest_year(df).collect()} == {2, 3}


def test_quartiles_of_large_groups_are_exact(spark):
    """More days than a sketch keeps, in many parts: every rank is still the nearest."""
    rows = 60_000
    days = spark.range(0, rows, 1, 7).select(
        F.lit("2020-01-05").alias("date"), F.lit(2020).alias("year"), F.lit("F").alias("country"),
        F.lit("P").alias("city"), (F.pmod(F.col("id") * 7919, F.lit(rows)) + 0.5).alias("temperature_mean"),
        (F.col("id") % 7 / 4).alias("windspeed_mean"),
    )
    found = profiles.quartiles(days).first()
    assert (found.temp_q25, found.temp_median, found.temp_q75) == (14_999.5, 29_999.5, 44_999.5)
    assert (found.wind_q25, found.wind_median, found.wind_q75) == (0.25, 0.75, 1.25)
