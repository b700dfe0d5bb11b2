"""The jobs as a user runs them: from landed files to anomalies, through folders."""

import json
import random
from pathlib import Path

import pytest

from isobar import schemas
from isobar.__main__ import main
from isobar.sources import documents as stored


def put(path, lines):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join(map(json.dumps, lines)), encoding="utf-8")


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """History of two cities landed and turned into stored profiles and records."""
    folder = str(tmp_path_factory.mktemp("cli"))
    pick = random.Random(2)
    days = [f"{year}-01-{d:02d}" for year in (2020, 2021) for d in range(1, 29)]
    responses = [
        {
            "latitude": 48.5, "longitude": 2.25, "city": city, "country": "France",
            "daily": {
                "time": days,
                "temperature_2m_mean": [pick.choice([4.0, 5.0, 6.0]) for _ in days],
                "temperature_2m_max": [8.0 for _ in days],
                "temperature_2m_min": [1.0 for _ in days],
                "precipitation_sum": [0.5 for _ in days],
                "windspeed_10m_max": [9.0 for _ in days],
                "windspeed_10m_mean": [pick.choice([3.0, 4.0, 5.0]) for _ in days],
            },
        }
        for city in ("Paris", "Lyon")
    ]
    put(f"{folder}/responses/part.json", responses)
    main(["land-history", "--responses", f"{folder}/responses", "--base", folder, "--skip-messages"])
    for job in ("records", "seasonal", "enrich"):
        out = ["--base", folder, "--sink", "json", "--output", f"{folder}/{job}-messages"]
        main([job, "--history", folder, "--layout", "table", *out])
    return folder


def test_documents_are_stored_and_sent(spark, base):
    assert spark.read.json(f"{base}/records-messages").count() == 2
    assert spark.read.json(f"{base}/enrich-messages").count() == 4
    records = stored.stored(spark, base, "records", schemas.RECORD_DOCUMENT).collect()
    assert {row.records.hottest_day.date for row in records} == {"2021-01-28"}
    assert stored.enriched_profiles(spark, base, "table").count() == 4


def test_live_readings_end_as_anomalies(spark, base):
    live = f"{base}/live"
    weather = [(30.0, 4.0), (5.0, 4.0), (5.0, 25.0)]
    put(f"{live}/responses/part.json", [
        {"latitude": 48.5, "longitude": 2.25, "city": "Paris", "country": "France",
         "current_weather": {"temperature": t, "windspeed": w, "weathercode": 3, "time": "2024-01-12T10:00"}}
        for t, w in weather
    ])
    main(["wrap-readings", "--responses", f"{live}/responses", "--sink", "json", "--output", f"{live}/raw"])
    raw = spark.read.schema("key string, value string").json(f"{live}/raw")
    # The producer stamps now; January readings are what the profiles cover.
    moved = raw.selectExpr("key", r"regexp_replace(value, '\"timestamp\":\"[^\"]*\"', '\"timestamp\":\"2024-01-12T10:00:00\"') as value")
    moved.write.json(f"{live}/raw-january")

    def stream(job, source, *more):
        main([job, "--source", "json", "--input", source, "--checkpoint", f"{live}/{job}-checkpoint", "--once", *more])

    stream("transform", f"{live}/raw-january", "--sink", "json", "--output", f"{live}/flat", "--event-time", "payload")
    stream("alerts", f"{live}/flat/*/*", "--base", base)
    stream("windows", f"{live}/flat/*/*", "--output", f"{live}/windows")
    stream("detect", f"{live}/flat/*/*", "--base", base, "--sink", "json", "--output", f"{live}/anomalies")

    assert stored.archived_alerts(spark, base).count() == 2
    assert spark.read.parquet(f"{live}/windows").count() == 5
    kinds = [json.loads(row.value)["anomaly_type"] for row in spark.read.json(f"{live}/anomalies").collect()]
    # Each anomalous reading is also an alert where history has none: two messages of its type.
    assert sorted(kinds) == ["heat_wave", "heat_wave", "wind_storm", "wind_storm"]
    archived = {row.anomaly_type for row in stored.archived_anomalies(spark, base).collect()}
    assert archived == {"heat_wave", "wind_storm"}


@pytest.mark.parametrize(
    ("table", "shows"),
    [
        ("cities", "Lyon"), ("city-history", "2020-01-01"), ("city-records", "2021-01-28"), ("city-profile", "2021"),
        ("history-summary", "56"), ("extreme-months", "Jan"),
    ],
)
def test_show(spark, base, table, shows, capfd):
    main(["show", table, "--base", base, "--country", "France", "--city", "Paris"])
    assert shows in capfd.readouterr().out


def test_sql_over_stored_tables(spark, base, capfd):
    statement = "select city, count(*) as days from daily_history group by city order by city"
    main(["sql", statement, "--base", base])
    shown = capfd.readouterr().out
    assert "Lyon" in shown and "56" in shown


def test_sql_over_live_readings(spark, base, capfd):
    flat = f"{base}/live/flat/*/*"
    statement = "select city, count(*) as total_alerts from weather_transformed where heat_alert_level = 'level_1' group by city"
    main(["sql", statement, "--source", "json", "--input", flat])
    assert "|Paris|1" in capfd.readouterr().out


def test_ingested_days_give_the_same_records(spark, base):
    main(["ingest", "--history", base, "--layout", "table", "--base", f"{base}/ingested"])
    rows = stored.daily_history(spark, f"{base}/ingested", "rows")
    documents = stored.daily_history(spark, base, "table").select(rows.columns)
    assert rows.exceptAll(documents).count() == documents.exceptAll(rows).count() == 0
    city = rows.where("country = 'France' and city = 'Paris'")
    plan = city._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country,France), EqualTo(city,Paris)" in plan
    main(["records", "--history", f"{base}/ingested", "--layout", "rows", "--base", f"{base}/ingested", "--skip-messages"])
    found, wanted = (
        stored.stored(spark, folder, "records", schemas.RECORD_DOCUMENT).select("city", "records")
        for folder in (f"{base}/ingested", base)
    )
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_profiles_from_states_are_those_of_the_history(spark, base):
    folder = f"{base}/states"
    for _ in range(2):  # an ingest of one name counts once
        main(["add-days", "--history", base, "--layout", "table", "--base", folder, "--name", "all"])
    main(["compact", "profile-state", "--base", folder])
    main(["enrich", "--states", folder, "--base", folder, "--skip-messages"])
    columns = ["city", "year", "month", "total_days", "avg_temperature", "temp_median", "alert_probability"]
    found, wanted = (
        sorted(map(str, stored.enriched_profiles(spark, place, "table").select(*columns).collect())) for place in (folder, base)
    )
    assert found == wanted and len(found) == 4


def test_a_merged_ingest_replaces_a_city(spark, base, tmp_path):
    folder = str(tmp_path)
    main(["ingest", "--history", base, "--layout", "table", "--base", folder])
    before = stored.daily_history(spark, folder, "rows").count()
    response = {"latitude": 48.5, "longitude": 2.25, "city": "Paris", "country": "France", "daily": {"time": ["2024-02-01"], "temperature_2m_mean": [7.0]}}
    put(f"{folder}/new/part.json", [response])
    main(["land-history", "--responses", f"{folder}/new", "--base", f"{folder}/landed", "--skip-messages"])
    main(["ingest", "--merge", "--history", f"{folder}/landed", "--layout", "table", "--base", folder])
    after = {row.city: row["count"] for row in stored.daily_history(spark, folder, "rows").groupBy("city").count().collect()}
    assert after == {"Paris": 1, "Lyon": before // 2}
