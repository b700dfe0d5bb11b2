"""Files in the stored layouts, and writers that replace or append."""

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import documents, history, profiles, readings, records, serving
from isobar.sinks import writers
from isobar.sources import documents as stored
from isobar.sources import messages as inbox
from tests.test_climate import daily, day


def put(base, path, content):
    file = Path(base) / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(content if isinstance(content, str) else json.dumps(content, indent=2), encoding="utf-8")


def history_file(city, country, **arrays):
    location = {"latitude": 48.5, "longitude": 2.25, "city": city, "country": country}
    return {"metadata": {"location": location, "source": "s"}, "data": {"daily": arrays}}


def test_history_tree(spark, folder):
    one = history_file("Paris", "France", time=["2020-01-01", "2020-01-02"], temperature_2m_mean=[1, 2.5])
    put(folder, "France/Paris/weather_history_raw/historical_data.json", one)
    two = history_file("Lyon", "France", time=["2021-01-01"], temperature_2m_mean=[None])
    put(folder, "France/Lyon/weather_history_raw/historical_data.json", two)
    put(folder, "France/Nice/weather_history_raw/historical_data.json", "broken {")
    put(folder, "France/Nice/alerts.json", "{}")
    rows = stored.daily_history(spark, folder).orderBy("city", "date").collect()
    assert [(r.city, r.date, r.temperature_mean) for r in rows] == [
        ("Lyon", "2021-01-01", None), ("Paris", "2020-01-01", 1.0), ("Paris", "2020-01-02", 2.5),
    ]


def test_history_landing_replaces_one_city(spark, folder):
    def land(city, days):
        daily_arrays = F.from_json(
            F.lit(json.dumps({"time": days})), schemas.HISTORY_DOCUMENT["data"].dataType["daily"].dataType
        )
        response = spark.range(1).select(
            F.lit(48.5).alias("latitude"), F.lit(2.25).alias("longitude"), F.lit(city).alias("city"),
            F.lit("France").alias("country"), F.lit(None).cast("string").alias("location_name"),
            daily_arrays.alias("daily"),
        )
        until = F.lit("2024-03-01").cast("date")
        writers.store_history(history.wrap_history(response, 1, until), folder)

    land("Le Mans", ["2020-01-01"])
    land("Paris", ["2020-01-01", "2020-01-02"])
    land("Paris", ["2021-01-01", "2021-01-02", "2021-01-03"])
    counts = stored.daily_history(spark, folder, "table").groupBy("city").count().collect()
    assert {row.city: row["count"] for row in counts} == {"Le Mans": 1, "Paris": 3}
    period = stored.history_documents(spark, folder, "table").select("metadata.period.*").distinct().collect()
    assert [tuple(row) for row in period] == [("2023-03-02", "2024-03-01", 1)]
    assert (Path(folder) / "history/country_dir=France/city_dir=Le_Mans").is_dir()


def test_alert_lines_tolerate_junk(spark, folder):
    line = {"timestamp": "2024-01-01T00:00:00", "alert_data": {"city": "Paris", "temperature": 40.0}}
    untimed = {"alert_data": {"city": "Paris"}}
    lines = [json.dumps(line), "junk", json.dumps({"timestamp": "x"}), "", json.dumps(untimed)]
    put(folder, "France/Paris/alerts.json", "\n".join(lines))
    rows = stored.archived_alerts(spark, folder, "tree").collect()
    assert sorted(r.saved_timestamp for r in rows) == ["", "2024-01-01T00:00:00"]


def test_anomaly_tree(spark, folder):
    file = {"country": "France", "city": "Paris", "year": 2024, "month": 1, "total_anomalies": 2,
            "anomalies": [{"anomaly_type": "heat_wave"}, {"anomaly_type": "wind_storm"}]}
    put(folder, "France/Paris/anomalies/2024/01/anomalies.json", file)
    put(folder, "France/Paris/anomalies/2024/02/anomalies.json", {**file, "month": 2})
    rows = stored.archived_anomalies(spark, folder, "tree")
    assert rows.count() == 4
    assert serving.city_count(rows, "France", "Paris").first()["count"] == 4
    assert serving.city_count(rows, "France", "Lyon").first()["count"] == 0


def test_enriched_documents_survive_storage(spark, folder):
    df = daily(
        spark,
        *(day(f"2020-{m:02d}-{d:02d}", mean=float(m)) for m in (1, 2) for d in (1, 2)),
        *(day(f"2021-01-{d:02d}", mean=0.0, city="a/b c") for d in (1, 2)),
    )
    profile = profiles.full_profile(df)
    built = documents.enriched_documents(profile, profiles.completeness(profile))
    writers.store_documents(built, folder, "enriched", by_year=True)
    again = stored.enriched_profiles(spark, folder, "table")
    assert {(r.city, r.year, r.month, r.avg_temperature) for r in again.collect()} == {
        ("Paris", 2020, 1, 1.0), ("Paris", 2020, 2, 2.0), ("a/b c", 2021, 1, 0.0),
    }
    assert (Path(folder) / "enriched/country_dir=France/city_dir=a_b_c/year_dir=2021").is_dir()


def test_enriched_tree_defaults(spark, folder):
    months = [{"month": 1, "avg_temperature": 3.0}, {"month": None}, {"month": 0}]
    put(folder, "France/Paris/seasonal_profile_enriched/2020/profile.json",
        {"country": "France", "city": "Paris", "year": 2020, "monthly_profiles": months})
    rows = stored.enriched_profiles(spark, folder).collect()
    assert [(r.month, r.avg_temperature, r.alert_probability) for r in rows] == [(1, 3.0, 0.0)]


def test_documents_of_other_cities_stay(spark, folder):
    def store(city, top):
        built = documents.record_documents(records.climate_records(daily(spark, day("2020-01-01", top=top, city=city))))
        writers.publish_documents(built, documents.document_messages(built), folder, "records", ("json", f"{folder}/out"))

    store("Paris", 30.0)
    store("Lyon", 31.0)
    store("Paris", 33.0)
    rows = stored.stored(spark, folder, "records", schemas.RECORD_DOCUMENT).collect()
    assert {row.city: row.records.hottest_day.temperature for row in rows} == {"Paris": 33.0, "Lyon": 31.0}
    sent = spark.read.schema("key string, value string").json(f"{folder}/out")
    assert sorted(row.key for row in sent.collect()) == ["France/Lyon", "France/Paris", "France/Paris"]


def test_either_output_can_be_skipped(spark, folder):
    built = documents.seasonal_documents(profiles.seasonal_profile(daily(spark, day("2020-01-01"))))
    writers.publish_documents(built, None, folder, "seasonal", None)
    writers.publish_documents(built, documents.document_messages(built), None, "seasonal", ("json", f"{folder}/out"))
    assert stored.stored(spark, folder, "seasonal", schemas.SEASONAL_DOCUMENT).count() == 1
    assert spark.read.json(f"{folder}/out").count() == 1


def test_a_retried_batch_is_archived_once(spark, folder):
    rows = spark.createDataFrame([("F", "P", 1), ("F", "L", 2)], "country string, city string, n int")
    for number in (0, 0, 1, 1):
        writers.archive_batch(rows, folder, ["country", "city"], writers.Batch("run", number))
    assert spark.read.json(folder).count() == 4
    writers.archive_batch(rows, folder, ["country", "city"], writers.Batch("later", 0))
    assert spark.read.json(folder).count() == 6


def test_a_retry_with_fewer_places_leaves_nothing_behind(spark, folder):
    rows = spark.createDataFrame([("F", "P", 1), ("F", "L", 2)], "country string, city string, n int")
    for part in (rows, rows.where("n = 1")):
        writers.archive_batch(part, folder, ["country", "city"], writers.Batch("run", 0))
    assert [row.n for row in spark.read.json(folder).collect()] == [1]


def test_compacting_keeps_the_rows(spark, folder):
    row = ("t", "heat_wave", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "France", "Paris", 2024, 1)
    names = [*schemas.ANOMALY_ROW.fieldNames(), *schemas.ANOMALY_PLACE.fieldNames()]
    place = schemas.ANOMALY_PLACE.fieldNames()
    for batch_id in range(3):
        one = spark.createDataFrame([row], names)
        writers.archive_batch(one, f"{folder}/a/anomalies", place, writers.Batch("run", batch_id))
    writers.compact_archive(stored.archived_anomalies(spark, f"{folder}/a"), f"{folder}/b/anomalies", place)
    compacted = stored.archived_anomalies(spark, f"{folder}/b")
    assert (compacted.count(), len(compacted.inputFiles())) == (3, 1)


def test_city_lookups_read_only_their_files(spark, folder):
    """Every stored layout is pruned to the place before anything is parsed."""
    days = daily(spark, day("2020-01-01", city="New York"), day("2020-01-01", city="Lyon"))
    writers.store_documents(documents.record_documents(records.climate_records(days)), folder, "records")
    profile = profiles.full_profile(days)
    built = documents.enriched_documents(profile, profiles.completeness(profile))
    writers.store_documents(built, folder, "enriched", by_year=True)
    graded = readings.grade_alerts(
        spark.createDataFrame(
            [("France", "New York", 1.0, 2.0, 40.0, 30.0), ("France", "Lyon", 1.0, 2.0, 40.0, 30.0)],
            "country string, city string, latitude double, longitude double, temperature double, windspeed double",
        )
    )
    entries = readings.alert_entries(graded)
    writers.archive_batch(entries, f"{folder}/alerts", ["country_dir", "city_dir"], writers.Batch("run", 0))
    place = ("France", "New York")
    found = {
        "records": stored.stored(spark, folder, "records", schemas.RECORD_DOCUMENT, place=place),
        "enriched": stored.enriched_profiles(spark, folder, "table", place),
        "alerts": stored.archived_alerts(spark, folder, place=place),
    }
    for kind, rows in found.items():
        filters = next(line for line in plan_of(rows).splitlines() if "PartitionFilters" in line)
        filters = filters.split("PartitionFilters: [")[1].split("]")[0]
        assert "country_dir" in filters and "city_dir" in filters, kind
        assert {row.city for row in rows.collect()} == {"New York"}, kind
    assert {row.city for row in stored.stored_places(spark, folder, "records").collect()} == {"New_York", "Lyon"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def messages(spark, *values):
    rows = [(None, value, None, "t", i % 2, i) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def test_first_messages_skip_junk(spark):
    found = inbox.first_messages(messages(spark, '{"a":1}', "junk", '{"a":3}', '{"a":4}', '{"a":5}'), 3)
    assert [(row.partition, row.offset) for row in found.collect()] == [(0, 0), (0, 2), (0, 4)]


def test_messages_round_trip_through_files(spark, folder):
    sent = messages(spark, '{"a":1}', "x")
    sent.write.json(f"{folder}/json")
    sent.write.parquet(f"{folder}/parquet")
    for kind in ("json", "parquet"):
        assert inbox.message_table(spark, kind, f"{folder}/{kind}").count() == 2
    put(folder, "text/part.txt", '{"a":1}\nx\n')
    lines = inbox.message_table(spark, "text", f"{folder}/text").collect()
    assert [row.value for row in lines] == ['{"a":1}', "x"]
    with pytest.raises(ValueError, match="unknown message source"):
        inbox.message_table(spark, "carrier-pigeon", folder)


def test_split_valid(spark):
    valid, quarantine = readings.split_valid(
        messages(spark, '{"current_weather": {"temperature": 1}}', '{"msg": "hi"}', "not json", "", None, "[1]")
    )
    assert {(row.value, row.kind) for row in valid.collect()} == {
        ('{"current_weather": {"temperature": 1}}', "reading"), ('{"msg": "hi"}', "other_json"), ("[1]", "other_json"),
    }
    assert {row.value for row in quarantine.collect()} == {"not json", "", None}


def test_malformed_messages_flow_through_as_calm(spark):
    parsed = readings.parse_messages(messages(spark, "not json", '{"msg": 1}', "", None), schemas.RAW_READING, ["offset"])
    flat = readings.flatten_readings(parsed, "payload", ["offset"]).orderBy("offset").collect()
    assert len(flat) == 4
    for row in flat:
        assert (row.temperature, row.city) == (None, None)
        assert (row.wind_alert_level, row.heat_alert_level) == ("level_0", "level_0")


def test_null_fields_are_absent_from_messages(spark):
    text = '{"location": {"latitude": 1.0, "longitude": 2.0}, "current_weather": {"temperature": 30}}'
    flat = readings.flatten_readings(readings.parse_messages(messages(spark, text), schemas.RAW_READING), "received")
    body = json.loads(readings.reading_messages(flat).first().value)
    assert body == {"latitude": 1.0, "longitude": 2.0, "temperature": 30.0, "wind_alert_level": "level_0",
                    "heat_alert_level": "level_1"}


def test_envelopes_drop_unusable_responses(spark):
    weather = {"temperature": 1.0, "windspeed": 2.0, "weathercode": 3}
    responses = [
        {"latitude": 1.0, "longitude": 2.0, "city": "Paris", "country": "France", "current_weather": weather},
        {"latitude": 1.0, "longitude": 2.0, "city": "", "country": "France", "current_weather": weather},
        {"latitude": 91.0, "longitude": 2.0, "current_weather": weather},
        {"latitude": 1.0, "longitude": 2.0},
    ]
    landed = spark.createDataFrame([(json.dumps(r),) for r in responses], "v string").select(
        F.from_json("v", schemas.CURRENT_RESPONSE).alias("r")
    )
    rows = readings.reading_envelopes(landed.select("r.*"), "open-meteo").collect()
    assert [row.key for row in rows] == ["France/Paris", "1.0,2.0"]
    assert json.loads(rows[1].value)["location"] == {"latitude": 1.0, "longitude": 2.0, "country": "France"}


def test_a_bounded_read_touches_the_beginning_of_a_log(spark, folder):
    """1,000 readable messages of a long log: the scan gets a bound on the offset."""
    log = spark.range(200_000).select(
        F.lit("k").alias("key"), F.when(F.col("id") % 5 == 0, "junk").otherwise(F.concat(F.lit('{"n":'), "id", F.lit("}"))).alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit("t").alias("topic"),
        (F.col("id") % 4).cast("int").alias("partition"), F.floor(F.col("id") / 4).alias("offset"),
    )
    log.repartitionByRange(16, "partition", "offset").sortWithinPartitions("partition", "offset").write.parquet(f"{folder}/log")
    messages = inbox.message_table(spark, "parquet", f"{folder}/log")
    found = inbox.first_messages(messages, 1000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    bounds = [int(n) for n in re.findall(r"LessThan\(offset,(\d+)\)", plan)]
    assert bounds and max(bounds) <= 4000
    plain = [r.offset for r in log.where("partition = 0 and value <> 'junk'").orderBy("offset").limit(1000).collect()]
    assert [r.offset for r in found.collect()] == plain
    # More than the first partition holds, and more than there is.
    many = inbox.first_messages(messages, 41_000).groupBy("partition").count().collect()
    assert sorted((r.partition, r["count"]) for r in many) == [(0, 40_000), (1, 1_000)]
    assert inbox.first_messages(messages, 10**6).count() == 160_000 and inbox.first_messages(messages, 0).count() == 0


def test_places_keep_their_names(spark, folder):
    rows = [("007", "Land"), ("1e3", "Land"), ("2024-01-01", "Land")]
    documents = spark.createDataFrame(rows, "city string, country string").select(
        F.struct(F.struct("city", "country").alias("location")).alias("metadata"), F.lit(1).alias("x")
    )
    writers.store_history(documents, folder)
    assert sorted(r.city for r in stored.stored_places(spark, folder).collect()) == ["007", "1e3", "2024-01-01"]
