"""The streaming jobs run over the tables until all input is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar import schemas
from isobar.functions.places import location_key
from isobar.operators import readings, summaries
from isobar.plans.anomaly import MESSAGE_COLUMNS, reference
from isobar.plans.live import ROUND_TRIP_COLUMNS, ROUND_TRIP_SQL, windows_sql
from isobar.plans.registry import query, second_text
from isobar.plans.views import FLAGS, MESSAGES, MOVED_READINGS, READINGS, flags, over
from isobar.sinks.archive import compact_archive, drop_covered
from isobar.sources import tables
from isobar.sources.documents import ARCHIVES, archived_alerts, archived_anomalies
from isobar.sources.messages import message_stream
from isobar.storage import scratch_path
from isobar.streaming import jobs

_UNTIL_READ: jobs.Trigger = {"availableNow": True}


def _raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_messages(tables.as_readings(tables.event_stream(spark, sf_dir)))


def _flat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded readings as the JSON messages a transform job sends."""
    return _flat_messages(tables.event_stream(spark, sf_dir))


def _flat_messages(events: DataFrame) -> DataFrame:
    return _as_flat_messages(tables.as_readings(events))


def _as_flat_messages(live: DataFrame) -> DataFrame:
    graded = readings.grade_alerts(live)
    fields = [name for name in schemas.FLAT_READING.fieldNames() if name in graded.columns]
    return graded.select(
        location_key().alias("key"),
        F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"),
        F.col("event_time").alias("timestamp"),
    )


@query(over(MESSAGES, ROUND_TRIP_SQL.replace("select reading_id, ", "select ", 1)))
def stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "transform")
    jobs.start_transform(
        _raw_stream(spark, sf_dir), ("json", f"{base}/out"), f"{base}/checkpoint", _UNTIL_READ, event_time="payload"
    ).awaitTermination()
    sent = spark.read.schema("key string, value string").json(f"{base}/out")
    back = readings.parse_flat_readings(sent.withColumn("timestamp", F.lit(None).cast("timestamp")))
    timed = readings.with_event_timestamp(back).withColumn("event_time", second_text("event_timestamp"))
    return timed.select(*ROUND_TRIP_COLUMNS)


@query(windows_sql(5, 1))
def stream_sliding_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "windows")
    jobs.start_window_metrics(
        _flat_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", trigger=_UNTIL_READ
    ).awaitTermination()
    last = jobs.read_windows(spark, f"{base}/out").drop("computed_at")
    return last.withColumns({name: second_text(name) for name in ("window_start", "window_end")})


@query(
    f"select * from ({windows_sql(5, 1)}) where window_end > "
    "(select strftime(max(ts) - interval '10 minutes', '%Y-%m-%d %H:%M:%S') from events)"
)
def stream_current_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still open, from the state of the job."""
    base = scratch_path(spark, "windows")
    jobs.start_window_metrics(
        _flat_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", trigger=_UNTIL_READ
    ).awaitTermination()
    last = jobs.read_current_windows(spark, f"{base}/checkpoint")
    return last.withColumns({name: second_text(name) for name in ("window_start", "window_end")})


# Readings in three batches: the second is of other rows of the same time, so what is more
# than ten minutes before its end comes late.
_BATCHES = 3


def _batched_messages(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The messages of all readings as files of their own, read one in a micro-batch."""
    flat = _flat_messages(tables.table(spark, sf_dir, "events"))
    numbered = flat.withColumns({"topic": F.lit("weather_transformed"), "partition": F.lit(0), "offset": F.xxhash64("value")})
    for number in range(_BATCHES):
        own = numbered.where(F.pmod(F.minute("timestamp"), F.lit(_BATCHES)) == number)
        own.select(*schemas.MESSAGE.fieldNames()).coalesce(1).write.json(f"{path}/batch-{number}")
    return message_stream(spark, "json", f"{path}/*", maxFilesPerTrigger="1")


@query(
    over(
        READINGS,
        """
select case when minute(event_time) % 3 = 0
                 or event_time >= (select max(event_time) from transformed p
                                   where minute(p.event_time) % 3 < minute(t.event_time) % 3) - interval '10 minutes'
            then 'on_time' else 'late' end as arrival,
       count(*) as readings, sum(temperature) as temperature
from transformed t group by all""",
    )
)
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows as data: together with those on time they are the input."""
    base = scratch_path(spark, "arrivals")
    jobs.start_arrival_split(
        _batched_messages(spark, sf_dir, f"{base}/in"), f"{base}/out", f"{base}/checkpoint", trigger=_UNTIL_READ
    ).awaitTermination()
    found = jobs.read_arrivals(spark, f"{base}/out").groupBy("arrival")
    return found.agg(F.count(F.lit(1)).alias("readings"), F.sum("temperature").alias("temperature"))


@query(
    over(
        READINGS,
        """
select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, temperature
from transformed order by transformed.event_time desc limit 1000""",
    )
)
def stream_live_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 1,000 messages, kept while three micro-batches come in."""
    base = scratch_path(spark, "buffer")
    jobs.start_live_buffer(
        _batched_messages(spark, sf_dir, f"{base}/in"), f"{base}/out", f"{base}/checkpoint",
        lambda: [F.desc("timestamp"), F.desc("offset")], trigger=_UNTIL_READ,
    ).awaitTermination()
    held = readings.parse_flat_readings(jobs.read_live_buffer(spark, f"{base}/out"))
    timed = readings.with_event_timestamp(held).withColumn("event_time", second_text("event_timestamp"))
    return timed.select("event_time", "temperature")


@query(
    over(
        READINGS,
        """
select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, temperature, windspeed, wind_alert_level,
       heat_alert_level,
       case when country is null or city is null then 'Lat_' || cast(latitude as varchar) else country end
         as country_dir,
       case when country is null or city is null then 'Lon_' || cast(longitude as varchar) else city end as city_dir
from transformed where wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0'""",
    )
)
def stream_alert_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "archive")
    jobs.start_alert_archive(
        _flat_stream(spark, sf_dir), base, f"{base}/checkpoint", _UNTIL_READ
    ).awaitTermination()
    stored = readings.with_event_timestamp(archived_alerts(spark, base))
    return stored.withColumn("event_time", second_text("event_timestamp")).select(
        "event_time", "temperature", "windspeed", "wind_alert_level", "heat_alert_level", "country_dir", "city_dir"
    )


_ALERT_COLUMNS = "event_time", "temperature", "windspeed", "wind_alert_level", "heat_alert_level"


def _archive_in_two_runs(spark: SparkSession, sf_dir: str) -> str:
    """Even and odd readings archived by two runs, each with a checkpoint of its own, into one base."""
    base = scratch_path(spark, "archive")
    for half in (0, 1):
        events = tables.event_stream(spark, sf_dir).where(F.col("event_id") % 2 == half)
        jobs.start_alert_archive(_flat_messages(events), base, f"{base}/checkpoint-{half}", _UNTIL_READ).awaitTermination()
    return base


_ARCHIVED_SQL = """
select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, temperature, windspeed, wind_alert_level,
       heat_alert_level
from transformed where (wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0')"""


def _archived(alerts: DataFrame) -> DataFrame:
    timed = readings.with_event_timestamp(alerts).withColumn("event_time", second_text("event_timestamp"))
    return timed.select(*_ALERT_COLUMNS)


@query(over(READINGS, _ARCHIVED_SQL))
def stream_archive_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived(archived_alerts(spark, _archive_in_two_runs(spark, sf_dir)))


def _compacted(spark: SparkSession, sf_dir: str) -> str:
    """An archive of three runs, compacted after the first and, in full, after the second."""
    base = scratch_path(spark, "archive")
    schema, partitions = ARCHIVES["alerts"]
    for third in range(3):
        events = tables.event_stream(spark, sf_dir).where(F.col("event_id") % 3 == third)
        jobs.start_alert_archive(_flat_messages(events), base, f"{base}/checkpoint-{third}", _UNTIL_READ).awaitTermination()
        if third < 2:
            compact_archive(spark, f"{base}/alerts", schema, partitions, full=third == 1)
            drop_covered(spark, f"{base}/alerts")
    return base


@query(over(READINGS, _ARCHIVED_SQL))
def stream_archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived(archived_alerts(spark, _compacted(spark, sf_dir)))


@query(over(READINGS, _ARCHIVED_SQL + " and country = 'NATION_14' and city = 'CITY_2'"))
def stream_archive_of_a_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _archive_in_two_runs(spark, sf_dir)
    return _archived(archived_alerts(spark, base, place=("NATION_14", "CITY_2")))


def _detected(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "anomalies")
    profile = reference(spark, sf_dir)
    jobs.start_anomaly_detector(
        _flat_stream(spark, sf_dir), lambda: profile, f"{base}/checkpoint", archive=base,
        statistics=f"{base}/statistics", trigger=_UNTIL_READ,
    ).awaitTermination()
    return base


@query(
    over(
        FLAGS,
        """
select anomaly_type, observed_temperature, expected_temperature, observed_windspeed, expected_windspeed,
       temp_deviation, wind_deviation, coalesce(country, 'Unknown') as country, coalesce(city, 'Unknown') as city,
       year, month
from flags where is_anomaly""",
    )
)
def stream_anomaly_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_anomalies(spark, _detected(spark, sf_dir)).drop("event_time", "run_id", "batch_id")


@query(
    over(
        FLAGS,
        """
select count(*) as "rows", count(distinct coalesce(country || '/' || city, latitude || ',' || longitude)) as distinct_keys,
       count(*) filter (where is_anomaly) as anomalies from flags""",
    )
)
def stream_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two runs over the same stream: keys that both have seen count once."""
    totals = None
    profile = reference(spark, sf_dir)
    for half in (0, 1):
        base = scratch_path(spark, "statistics")
        events = tables.event_stream(spark, sf_dir).where(F.col("event_id") % 2 == half)
        jobs.start_anomaly_detector(
            _flat_messages(events), lambda: profile, f"{base}/checkpoint",
            statistics=f"{base}/statistics", trigger=_UNTIL_READ,
        ).awaitTermination()
        read = spark.read.schema("rows bigint, anomalies bigint, keys binary").json(f"{base}/statistics")
        totals = read if totals is None else totals.unionByName(read)
    return summaries.merged_statistics(totals)


@query(
    over(
        FLAGS,
        'select count(*) as "rows", count(*) filter (where is_anomaly) as anomalies from flags',
    )
)
def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spark.read.schema("rows bigint, anomalies bigint").json(f"{_detected(spark, sf_dir)}/statistics")
    return counted.agg(F.sum("rows").alias("rows"), F.sum("anomalies").alias("anomalies"))


_BY_YEAR_SQL = f"""
select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, {MESSAGE_COLUMNS},
       (select count(*) from flags) as readings
from messages"""


def _sent_by_year(spark: SparkSession, sf_dir: str, year: str) -> DataFrame:
    """What a running detector sends about readings of many years, and how many readings it has flagged."""
    base = scratch_path(spark, "anomalies")
    profile = reference(spark, sf_dir, year)
    moved = tables.moved_in_time(tables.as_readings(tables.event_stream(spark, sf_dir)))
    jobs.start_anomaly_detector(
        _as_flat_messages(moved), lambda: profile, f"{base}/checkpoint", ("json", f"{base}/out"),
        statistics=f"{base}/statistics", profile_year=year, trigger=_UNTIL_READ,
    ).awaitTermination()
    flagged = spark.read.schema("rows bigint").json(f"{base}/statistics").agg(F.sum("rows").alias("readings"))
    # One row of totals.
    return _sent_anomalies(spark, f"{base}/out").join(F.broadcast(flagged))


def _sent_anomalies(spark: SparkSession, path: str) -> DataFrame:
    sent = spark.read.schema("key string, value string").json(path)
    messages = readings.parse_messages(
        sent.withColumn("timestamp", F.lit(None).cast("timestamp")), schemas.ANOMALY_MESSAGE
    ).drop("message_key", "received_at")
    timed = readings.with_event_timestamp(messages).withColumn("event_time", second_text("event_timestamp"))
    return timed.drop("event_timestamp")


@query(over(flags("same", MOVED_READINGS), _BY_YEAR_SQL))
def stream_anomalies_same_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sent_by_year(spark, sf_dir, "same")


@query(over(flags("as-of", MOVED_READINGS), _BY_YEAR_SQL))
def stream_anomalies_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sent_by_year(spark, sf_dir, "as-of")


@query(over(FLAGS, f"select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, {MESSAGE_COLUMNS} from messages"))
def stream_anomaly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "anomalies")
    profile = reference(spark, sf_dir)
    jobs.start_anomaly_detector(
        _flat_stream(spark, sf_dir),
        lambda: profile,
        f"{base}/checkpoint",
        sink=("json", f"{base}/out"),
        archive=base,
        statistics=f"{base}/statistics",
        trigger=_UNTIL_READ,
    ).awaitTermination()
    return _sent_anomalies(spark, f"{base}/out")
