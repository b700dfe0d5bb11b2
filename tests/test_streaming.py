"""The jobs on file streams: late rows, restarts, retries, batch equality."""

import datetime
import json
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import readings, serving, summaries, windows
from isobar.sources.documents import archived_alerts, archived_anomalies
from isobar.sources.messages import message_stream
from isobar.streaming import jobs

START = datetime.datetime(2024, 1, 1, 10, 30)
NOW = {"availableNow": True}


def flat(minute, temperature=26.0, wind=5.0, city="Paris"):
    at = None if minute is None else (START + datetime.timedelta(minutes=minute)).isoformat() + "Z"
    body = {
        "event_time": at, "country": "France", "city": city, "latitude": 48.5, "longitude": 2.25,
        "temperature": temperature, "windspeed": wind,
        "wind_alert_level": "level_2" if wind > 20 else "level_0",
        "heat_alert_level": "level_1" if temperature >= 25 else "level_0",
    }
    return json.dumps({k: v for k, v in body.items() if v is not None})


def drop(spark, folder, values, name):
    """Add one file of messages to the inbox."""
    rows = [(f"k{i}", value, None, "t", 0, i) for i, value in enumerate(values)]
    spark.createDataFrame(rows, schemas.MESSAGE).coalesce(1).write.mode("append").json(f"{folder}/inbox/{name}")


def inbox(spark, folder):
    return message_stream(spark, "json", f"{folder}/inbox/*", maxFilesPerTrigger="1")


def run_windows(spark, folder, **options):
    jobs.start_window_metrics(
        inbox(spark, folder), f"{folder}/out", f"{folder}/checkpoint", trigger=NOW, **options
    ).awaitTermination()
    return jobs.read_windows(spark, f"{folder}/out")


def test_windows_of_a_reading(spark, folder):
    drop(spark, folder, [flat(0)], "a")
    opened = [row.window_start.strftime("%H:%M") for row in run_windows(spark, folder).orderBy("window_start").collect()]
    assert opened == ["10:26", "10:27", "10:28", "10:29", "10:30"]


def test_late_rows_are_dropped_and_null_times_ignored(spark, folder):
    """A row inside the watermark changes its windows; one 30 minutes late does not."""
    drop(spark, folder, [flat(0), flat(40), flat(None)], "a")
    drop(spark, folder, [flat(41)], "b")
    drop(spark, folder, [flat(35, temperature=99.0), flat(5, temperature=99.0)], "c")
    counter = jobs.count_late_rows(spark)
    try:
        query = jobs.start_window_metrics(
            inbox(spark, folder), f"{folder}/out", f"{folder}/checkpoint", slide=None, trigger=NOW
        )
        query.awaitTermination()
        until = time.monotonic() + 20
        while counter.dropped.get(str(query.id)) != 1 and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert counter.dropped[str(query.id)] == 1
    found = jobs.read_windows(spark, f"{folder}/out")
    counts = {row.window_start.strftime("%H:%M"): (row.total_messages, row.max_temperature) for row in found.collect()}
    assert counts == {"10:30": (1, 26.0), "11:10": (2, 26.0), "11:05": (1, 99.0)}


def test_restart_continues_from_the_checkpoint(spark, folder):
    drop(spark, folder, [flat(0), flat(1)], "a")
    assert run_windows(spark, folder, slide=None).first().total_messages == 2
    drop(spark, folder, [flat(2, city="Lyon"), flat(3)], "b")
    found = {row.city: row.total_messages for row in run_windows(spark, folder, slide=None).collect()}
    assert found == {"Paris": 3, "Lyon": 1}
    assert {row.city: row.total_messages for row in run_windows(spark, folder, slide=None).collect()} == found


def test_append_mode_writes_closed_windows_once(spark, folder):
    drop(spark, folder, [flat(0)], "a")
    drop(spark, folder, [flat(60)], "b")
    drop(spark, folder, [flat(61)], "c")
    run_windows(spark, folder, slide=None, mode="append")
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert [(row.window_start.strftime("%H:%M"), row.total_messages) for row in rows] == [("10:30", 1)]


@pytest.mark.parametrize("by", ["location", "coordinates"])
def test_stream_equals_batch(spark, folder, by):
    """Rows out of order within the watermark, spread over several micro-batches."""
    values = [flat(m, temperature=float(20 + m % 9), wind=float(m % 30)) for m in (3, 0, 1, 7, 5, 9, 4, 12, 8, 15)]
    for i in range(0, len(values), 2):
        drop(spark, folder, values[i : i + 2], f"f{i}")
    streamed = run_windows(spark, folder, by=by).drop("computed_at")
    parsed = readings.parse_flat_readings(
        spark.createDataFrame([(None, v, None, "t", 0, 0) for v in values], schemas.MESSAGE)
    )
    batch = windows.window_metrics(parsed, by=by)
    columns = sorted(batch.columns)
    assert sorted(map(tuple, streamed.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


RAW = (
    '{"timestamp": "2024-01-12T10:30:00.123456", "location": {"latitude": 48.5, "longitude": 2.25, "city": "Paris", '
    '"country": "France"}, "current_weather": {"temperature": 38.0, "windspeed": 25.5, "winddirection": 180, '
    '"weathercode": 61, "time": "2024-01-12T10:00"}, "source": "open-meteo", "api_response": {"x": 1}}'
)


def test_transform_grades_and_counts(spark, folder):
    drop(spark, folder, [RAW, "not json"], "a")
    jobs.start_transform(
        inbox(spark, folder), ("json", f"{folder}/out"), f"{folder}/checkpoint", NOW, statistics=f"{folder}/stats"
    ).awaitTermination()
    sent = {row.key: json.loads(row.value) for row in spark.read.json(f"{folder}/out").collect()}
    assert sent["k0"]["wind_alert_level"] == sent["k0"]["heat_alert_level"] == "level_2"
    assert sent["k0"]["original_timestamp"] == "2024-01-12T10:30:00.123456" and "api_response" not in sent["k0"]
    assert set(sent["k1"]) == {"event_time", "wind_alert_level", "heat_alert_level"}
    statistics = spark.read.json(f"{folder}/stats").first()
    assert (statistics.rows, statistics.distinct_keys) == (2, 2)


def test_alert_archive_has_no_doubles_after_restart(spark, folder):
    def run():
        jobs.start_alert_archive(inbox(spark, folder), folder, f"{folder}/checkpoint", NOW).awaitTermination()
        return archived_alerts(spark, folder)

    drop(spark, folder, [flat(0), flat(1, temperature=5.0), flat(2, temperature=5.0, wind=30.0)], "a")
    assert run().count() == 2
    drop(spark, folder, [flat(3, city=None)], "b")
    rows = run().collect()
    assert len(rows) == 3
    assert {(row.country_dir, row.city_dir) for row in rows} == {("France", "Paris"), ("Lat_48.5", "Lon_2.25")}


def test_runs_with_new_checkpoints_add_to_the_same_outputs(spark, folder):
    """What a run stored stays when a job starts with a new checkpoint."""
    for n, values in enumerate(([flat(0), flat(1)], [flat(2, city="Lyon")])):
        drop(spark, f"{folder}/{n}", values, "a")
        source = inbox(spark, f"{folder}/{n}")
        jobs.start_alert_archive(source, folder, f"{folder}/{n}/alerts", NOW).awaitTermination()
        source = inbox(spark, f"{folder}/{n}")
        jobs.start_window_metrics(source, f"{folder}/w", f"{folder}/{n}/w", slide=None, trigger=NOW).awaitTermination()
    assert sorted(row.city for row in archived_alerts(spark, folder).collect()) == ["Lyon", "Paris", "Paris"]
    found = {row.city: row.total_messages for row in jobs.read_windows(spark, f"{folder}/w").collect()}
    assert found == {"Paris": 2, "Lyon": 1}


PROFILE = (
    "country string, city string, month int, avg_temperature double, std_temperature double, temp_median double, "
    "avg_windspeed double, std_windspeed double, wind_median double, alert_probability double"
)


def run_detector(spark, folder, load_profile):
    jobs.start_anomaly_detector(
        inbox(spark, folder),
        load_profile,
        f"{folder}/checkpoint",
        sink=("json", f"{folder}/out"),
        archive=folder,
        statistics=f"{folder}/stats",
        trigger=NOW,
    ).awaitTermination()


def test_detector_feeds_messages_archive_and_statistics(spark, folder):
    profile = spark.createDataFrame([("France", "Paris", 1, 5.0, 1.0, 5.0, 5.0, 1.0, 5.0, 50.0)], PROFILE)
    drop(spark, folder, [flat(0, wind=30.0), flat(1, temperature=5.0), flat(2, city="Lyon")], "a")
    run_detector(spark, folder, lambda: profile)
    sent = [json.loads(row.value) for row in spark.read.json(f"{folder}/out").collect()]
    assert {(m["variable"], m["anomaly_type"]) for m in sent} == {("temperature", "heat_wave"), ("windspeed", "heat_wave")}
    archived = archived_anomalies(spark, folder).collect()
    assert [(r.country, r.city, r.year, r.month, r.anomaly_type) for r in archived] == [
        ("France", "Paris", 2024, 1, "heat_wave")
    ]
    statistics = spark.read.json(f"{folder}/stats").first()
    assert (statistics.rows, statistics.distinct_keys, statistics.anomalies) == (3, 2, 1)


def test_detector_sees_a_recomputed_profile(spark, folder):
    """The profile is loaded per micro-batch: the second file meets the new one."""
    loaded = []

    def load_profile():
        expected = 26.0 if not loaded else 0.0
        loaded.append(expected)
        return spark.createDataFrame([("France", "Paris", 1, expected, 1.0, 0.0, 5.0, 1.0, 5.0, 50.0)], PROFILE)

    drop(spark, folder, [flat(0)], "a")
    drop(spark, folder, [flat(1)], "b")
    run_detector(spark, folder, load_profile)
    sent = [json.loads(row.value) for row in spark.read.json(f"{folder}/out").collect()]
    assert loaded == [26.0, 0.0]
    assert [m["expected_value"] for m in sent] == [0.0]


def test_profiles_are_refreshed_when_old(spark):
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        return spark.createDataFrame([(float(len(loads)),)], "v double")

    current = jobs.refreshed(load, 60.0, lambda: now[0])
    seen = []
    for now[0] in (0.0, 59.0, 60.0, 61.0, 200.0):
        seen.append(current().first().v)
    assert seen == [1.0, 1.0, 2.0, 2.0, 3.0]


def test_refreshing_keeps_at_most_two_copies(spark):
    now = [0.0]
    held = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = held()
    current = jobs.refreshed(lambda: spark.range(5).selectExpr(f"id + {int(now[0])} as v"), 60.0, lambda: now[0])
    for turn in range(10):
        now[0] = turn * 100.0
        current().count()
        assert held() - before <= 2


def test_repeats_within_the_watermark_are_dropped(spark, folder):
    drop(spark, folder, [flat(0), flat(0), flat(1)], "a")
    drop(spark, folder, [flat(0), flat(2)], "b")
    timed = readings.with_event_timestamp(readings.parse_flat_readings(inbox(spark, folder)))
    once = jobs.deduplicated(timed, ["country", "city", "event_timestamp"], "event_timestamp")
    query = once.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    query.trigger(**NOW).start(f"{folder}/out").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_supervise_restarts_a_failed_query(spark, folder):
    drop(spark, folder, [flat(0)], "a")
    attempts, pauses = [], []

    def start():
        attempts.append(1)

        def process(batch, batch_id):
            if len(attempts) < 3:
                raise RuntimeError("sink is down")
            batch.write.mode("append").json(f"{folder}/out")

        stream = inbox(spark, folder).writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        return stream.trigger(**NOW).foreachBatch(process).start()

    jobs.supervise(start, attempts=3, sleep=pauses.append)
    assert (len(attempts), pauses) == (3, [5.0, 5.0])
    assert spark.read.json(f"{folder}/out").count() == 1


def test_supervise_gives_up(spark, folder):
    drop(spark, folder, [flat(0)], "a")

    def start():
        failing = inbox(spark, folder).select(F.raise_error(F.lit("no")).alias("x"))
        stream = failing.writeStream.format("noop").option("checkpointLocation", f"{folder}/checkpoint")
        return stream.trigger(**NOW).start()

    with pytest.raises(StreamingQueryException):
        jobs.supervise(start, attempts=2, sleep=lambda _: None)


def test_text_stream(spark, folder):
    spark.createDataFrame([(RAW,), ("junk",)], "value string").write.text(f"{folder}/inbox/a")
    jobs.start_transform(
        message_stream(spark, "text", f"{folder}/inbox/*"), ("json", f"{folder}/out"), f"{folder}/checkpoint", NOW
    ).awaitTermination()
    assert spark.read.json(f"{folder}/out").count() == 2


def test_current_windows_come_from_the_state(spark, folder):
    """Open windows as the job last wrote them, without ranking what it wrote."""
    drop(spark, folder, [flat(0), flat(1, temperature=30.0), flat(2, city=None)], "a")
    drop(spark, folder, [flat(14, wind=25.0), flat(13)], "b")
    drop(spark, folder, [flat(15)], "c")
    written = run_windows(spark, folder)
    current = jobs.read_current_windows(spark, f"{folder}/checkpoint")
    end = START + datetime.timedelta(minutes=15) - datetime.timedelta(minutes=10)
    wanted = written.where(F.col("window_end") > F.lit(end)).drop("computed_at")
    names = sorted(wanted.columns)
    assert sorted(current.columns) == names
    found = sorted(map(str, current.select(*names).collect()))
    assert found == sorted(map(str, wanted.select(*names).collect())) and 0 < len(found) < written.count()
    assert "Window" not in current._jdf.queryExecution().executedPlan().toString()


def test_late_readings_are_kept_apart(spark, folder):
    """Late, on-time and untimed readings together are the input; late is what a window job drops."""
    drop(spark, folder, [flat(0), flat(40), flat(None)], "a")
    drop(spark, folder, [flat(41), flat(30), flat(29, temperature=77.0)], "b")
    drop(spark, folder, [flat(35, temperature=99.0), flat(5, temperature=88.0), flat(31)], "c")
    jobs.start_arrival_split(inbox(spark, folder), f"{folder}/out", f"{folder}/cp", trigger=NOW).awaitTermination()
    found = jobs.read_arrivals(spark, f"{folder}/out").collect()
    assert len(found) == 9
    minute = lambda row: (datetime.datetime.fromisoformat(row.event_time[:19]) - START).seconds // 60
    by = {kind: sorted(minute(r) for r in found if r.arrival == kind and r.event_time) for kind in jobs.ARRIVALS}
    assert by == {"on_time": [0, 30, 31, 35, 40, 41], "late": [5, 29], "untimed": []}
    assert [r.arrival for r in found if r.event_time is None] == ["untimed"]


def test_arrivals_go_on_after_a_restart(spark, folder):
    """The watermark of a new start is that of the batches before; a retried batch is filed once."""
    split = lambda: jobs.start_arrival_split(inbox(spark, folder), f"{folder}/out", f"{folder}/cp", trigger=NOW).awaitTermination()
    drop(spark, folder, [flat(60)], "a")
    split()
    drop(spark, folder, [flat(49), flat(50)], "b")
    split()
    commits = sorted(p.name for p in Path(f"{folder}/cp/commits").iterdir() if p.name.isdigit())
    Path(f"{folder}/cp/commits/{commits[-1]}").unlink()
    Path(f"{folder}/cp/commits/.{commits[-1]}.crc").unlink(missing_ok=True)
    split()
    found = [(r.arrival, r.event_time[14:16]) for r in jobs.read_arrivals(spark, f"{folder}/out").collect()]
    assert sorted(found) == [("late", "19"), ("on_time", "20"), ("on_time", "30")]


def messages_of(spark, numbers, topics=("a", "b")):
    rows = [(f"k{n}", f"v{n}", START + datetime.timedelta(seconds=n), t, 0, n) for n in numbers for t in topics]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def test_a_live_buffer_holds_the_last_messages(spark, folder):
    """After each batch the buffer equals the retained messages of all input so far."""
    order = lambda: [F.desc("timestamp"), F.desc("offset")]
    sent = None
    for turn, numbers in enumerate([range(3), range(3, 30), [1, 40], [50]]):
        topics = ("a", "b") if turn < 3 else ("c",)
        batch = messages_of(spark, numbers, topics)
        batch.coalesce(1).write.mode("append").json(f"{folder}/inbox/{turn}")
        sent = batch if sent is None else sent.unionByName(batch)
        jobs.start_live_buffer(
            inbox(spark, folder), f"{folder}/out", f"{folder}/cp", order, limit=7, trigger=NOW
        ).awaitTermination()
        held = jobs.read_live_buffer(spark, f"{folder}/out")
        wanted = serving.retained(sent, order(), "topic", 7).drop("rank")
        assert sorted(map(str, held.collect())) == sorted(map(str, wanted.collect()))
    assert len(list(Path(f"{folder}/out").glob("buffer-*"))) <= 2


def test_a_retried_batch_does_not_change_the_buffer(spark, folder):
    order = lambda: [F.desc("timestamp"), F.desc("offset")]
    run = lambda: jobs.start_live_buffer(inbox(spark, folder), f"{folder}/out", f"{folder}/cp", order, limit=5, trigger=NOW).awaitTermination()
    messages_of(spark, range(4), ("a",)).coalesce(1).write.json(f"{folder}/inbox/0")
    run()
    for name in ("0", ".0.crc"):
        Path(f"{folder}/cp/commits/{name}").unlink(missing_ok=True)
    run()
    assert jobs.read_live_buffer(spark, f"{folder}/out").count() == 4


def test_distinct_keys_over_batches(spark, folder):
    """Message keys that several batches hold count once; per batch they are what a count gives."""
    bodies = lambda cities: [
        json.dumps({"timestamp": "2024-01-01T00:00:00Z", "location": {"city": c, "country": "F"}, "current_weather": {"temperature": 1.0}})
        for c in cities
    ]
    drop(spark, folder, bodies(["A", "B", "A"]), "a")
    drop(spark, folder, bodies(["B", "C"]), "b")
    jobs.start_transform(
        inbox(spark, folder), ("json", f"{folder}/out"), f"{folder}/cp", NOW, statistics=f"{folder}/statistics"
    ).awaitTermination()
    each = spark.read.schema("rows bigint, distinct_keys bigint, anomalies bigint, keys binary").json(f"{folder}/statistics")
    assert sorted((r.rows, r.distinct_keys, r.anomalies) for r in each.collect()) == [(2, 2, 0), (3, 3, 0)]
    assert tuple(summaries.merged_statistics(each).first()) == (5, 3, 0)
    many = spark.range(200_000).select(F.concat(F.lit("key"), "id").alias("key"), (F.col("id") % 8).alias("batch"))
    sketched = many.groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(0).alias("anomalies"), summaries.key_sketch(F.col("key")).alias("keys")
    )
    assert abs(summaries.merged_statistics(sketched.unionByName(sketched)).first().distinct_keys / 200_000 - 1) < 0.03


def test_messages_that_are_no_json_are_set_aside(spark, folder):
    good = json.dumps({"timestamp": "2024-01-01T00:00:00Z", "location": {"city": "A"}, "current_weather": {"temperature": 26.0, "windspeed": 40.0}})
    drop(spark, folder, [good, "not json", "", '{"msg": "Hello"}'], "a")
    jobs.start_transform(
        inbox(spark, folder), ("json", f"{folder}/out"), f"{folder}/cp", NOW, quarantine=f"{folder}/quarantine",
        wind_unit="km/h", statistics=f"{folder}/statistics",
    ).awaitTermination()
    sent = [json.loads(row.value) for row in spark.read.schema("key string, value string").json(f"{folder}/out").collect()]
    aside = spark.read.schema(schemas.MESSAGE).json(f"{folder}/quarantine").collect()
    assert sorted(row.value for row in aside) == ["", "not json"] and len(sent) == 2
    assert {m.get("wind_alert_level") for m in sent} == {"level_1", "level_0"}  # 40 km/h are 11 m/s
    assert spark.read.json(f"{folder}/statistics").first().rows == 2


def test_repeated_readings_are_archived_once(spark, folder):
    drop(spark, folder, [flat(0), flat(0), flat(1)], "a")
    drop(spark, folder, [flat(1), flat(2, temperature=30.0), flat(2, temperature=31.0)], "b")
    jobs.start_alert_archive(inbox(spark, folder), folder, f"{folder}/cp", NOW, unique=True).awaitTermination()
    assert sorted(r.temperature for r in archived_alerts(spark, folder).collect()) == [26.0, 26.0, 30.0, 31.0]
