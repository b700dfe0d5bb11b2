"""The continuous jobs: transform, window metrics, alert archive, anomaly detection.

Each takes a message stream and returns the started query. Checkpoints belong to one
query each and are never wiped here; starting again with the same one resumes it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from isobar.functions.deviations import SIGMA_LIMIT, TEMPERATURE_LIMIT
from isobar.functions.places import location_key
from isobar.operators import anomalies, readings, summaries, windows
from isobar.operators.records import top_k_per_group
from isobar.operators.serving import RETAINED, retained
from isobar.schemas import ANOMALY_MESSAGE, FLAT_READING, RAW_READING
from isobar.sinks import manifest
from isobar.sinks.manifest import listed
from isobar.sinks.writers import Batch, archive_batch, send_messages

Trigger = dict[str, object]
Sink = tuple[str, str]

# Watermark and trigger intervals of the running jobs.
LATENESS = "10 minutes"
EVERY_5_SECONDS: Trigger = {"processingTime": "5 seconds"}
EVERY_10_SECONDS: Trigger = {"processingTime": "10 seconds"}


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint's own metadata gives the query; a new checkpoint has a new one."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def _run_batches(
    stream: DataFrame, checkpoint: str, trigger: Trigger, mode: str, process: Callable[[DataFrame, Batch], None]
) -> StreamingQuery:
    run: list[str] = []

    def numbered(rows: DataFrame, number: int) -> None:
        if not run:
            run.append(_run_id(rows.sparkSession, checkpoint))
        process(rows, Batch(run[0], number))

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(numbered).start()


def deduplicated(stream: DataFrame, keys: list[str], time_column: str, lateness: str = LATENESS) -> DataFrame:
    """Drop repeats that arrive within the watermark, for sources that deliver at least once."""
    return stream.withWatermark(time_column, lateness).dropDuplicatesWithinWatermark(keys)


def _observed(rows: DataFrame, key: Column, flag: Column | None = None) -> tuple[DataFrame, Observation]:
    """``rows``, and the statistics of whatever job reads them next: no job of its own."""
    observation = Observation()
    flagged = F.count_if(flag) if flag is not None else F.count_if(F.lit(False))
    measures = [F.count(F.lit(1)).alias("rows"), flagged.alias("anomalies"), summaries.key_sketch(key).alias("keys")]
    return rows.observe(observation, *measures), observation


def _statistics_row(spark: SparkSession, observation: Observation) -> DataFrame:
    found = observation.get
    return summaries.statistics_row(spark, found["rows"], found["anomalies"], found["keys"])


def start_transform(
    messages: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Trigger = EVERY_5_SECONDS,
    event_time: str = "processing",
    statistics: str | None = None,
    wind_unit: str = "m/s",
    nan_is_missing: bool = False,
    quarantine: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Raw readings to graded flat readings, with optional per-batch statistics.

    With ``quarantine``, messages that are no JSON are stored in that folder as they came
    and do not go on.
    """

    def graded(raw: DataFrame) -> DataFrame:
        parsed = readings.parse_messages(raw, RAW_READING)
        return readings.reading_messages(
            readings.flatten_readings(parsed, event_time, wind_unit=wind_unit, nan_is_missing=nan_is_missing)
        )

    out = messages if quarantine else graded(messages)

    def process(rows: DataFrame, batch: Batch) -> None:
        if not quarantine:
            deliver(rows, batch)
            return
        tagged = readings.classify_messages(rows).persist()
        try:
            archive_batch(tagged.where("kind = 'text'").drop("kind"), quarantine, [], batch)
            deliver(graded(tagged.where("kind <> 'text'").drop("kind")), batch)
        finally:
            tagged.unpersist()

    def deliver(rows: DataFrame, batch: Batch) -> None:
        if not statistics:
            send_messages(rows, *sink, batch=batch, **options)
            return
        seen, observation = _observed(rows, F.col("key"))
        send_messages(seen, *sink, batch=batch, **options)
        archive_batch(_statistics_row(rows.sparkSession, observation), statistics, [], batch)

    return _run_batches(out, checkpoint, trigger, "append", process)


def start_window_metrics(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "5 minutes",
    slide: str | None = "1 minute",
    by: str = "location",
    lateness: str = LATENESS,
    mode: str = "update",
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Window metrics per location, stored per micro-batch.

    In "update" mode a window is written every time it changes, read_windows() keeps
    its last state; in "append" mode it is written once, when the watermark passes it.
    """
    trigger = trigger or {"processingTime": slide or width}
    flat = readings.parse_flat_readings(messages, fields=windows.USED)
    metrics = windows.window_metrics(flat, width, slide, by, lateness)

    def process(rows: DataFrame, batch: Batch) -> None:
        archive_batch(windows.stamp_computed(rows), path, [], batch, "parquet")

    return _run_batches(metrics, checkpoint, trigger, mode, process)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last written state of every window, whichever run wrote it."""
    states = spark.read.parquet(path)
    keys = [name for name in ("window_start", "window_end", "location", "city", "country") if name in states.columns]
    newest = [F.desc("computed_at"), F.desc("batch_id"), F.desc("run_id")]
    return top_k_per_group(states, keys, newest, 1).drop("rank", "run_id", "batch_id")


def read_current_windows(spark: SparkSession, checkpoint: str, by: str = "location") -> DataFrame:
    """Windows that the watermark has not passed, as the last micro-batch left them.

    They are read from the state of the window job itself: nothing is ranked, and what the
    job has written over time is not opened. The job may be running.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return windows.metrics_of_state(state, by)


def _once(flat: DataFrame) -> DataFrame:
    """Flat readings without those that a source delivers again within the watermark."""
    timed = readings.with_event_timestamp(flat)
    keys = [name for name in FLAT_READING.fieldNames() if name in flat.columns]
    return deduplicated(timed, keys, "event_timestamp").drop("event_timestamp")


def start_alert_archive(
    messages: DataFrame, base: str, checkpoint: str, trigger: Trigger = EVERY_10_SECONDS, unique: bool = False
) -> StreamingQuery:
    """Alerts archived by country and city, each micro-batch exactly once.

    With ``unique``, a reading that the source delivers again within the watermark is
    archived once; readings without a readable time are then left out.
    """
    flat = readings.parse_flat_readings(messages)
    entries = readings.alert_entries(_once(flat) if unique else flat)

    def process(rows: DataFrame, batch: Batch) -> None:
        archive_batch(rows, f"{base}/alerts", ["country_dir", "city_dir"], batch)

    return _run_batches(entries, checkpoint, trigger, "append", process)


def refreshed(
    load: Callable[[], DataFrame], every: float, clock: Callable[[], float] = time.monotonic
) -> Callable[[], DataFrame]:
    """Load a profile once, and anew when it is ``every`` seconds old.

    Between refreshes micro-batches join the cached table, whose size Catalyst knows; what a
    lost executor held of it is read again. The copy before is let go when its successor
    is in use, so there are never more than two.
    """
    held: dict[str, object] = {}

    def current() -> DataFrame:
        now = clock()
        if not held or now - held["at"] >= every:
            before = held.get("profile")
            profile = load().persist()
            profile.count()  # a table read in full has a known size
            held.update(at=now, profile=profile)
            if before is not None:
                before.unpersist()
        return held["profile"]

    return current


def start_anomaly_detector(
    messages: DataFrame,
    load_profile: Callable[[], DataFrame],
    checkpoint: str,
    sink: Sink | None = None,
    archive: str | None = None,
    statistics: str | None = None,
    temp_threshold: float = TEMPERATURE_LIMIT,
    wind_threshold: float = SIGMA_LIMIT,
    temp_sigmas: float | None = None,
    profile_year: str = "earliest",
    trigger: Trigger = EVERY_5_SECONDS,
    **options: str,
) -> StreamingQuery:
    """Flag readings against the reference profile; messages, archive and statistics.

    One query feeds all three outputs from one evaluation of the join. ``load_profile``
    is called for every micro-batch, so a recomputed profile takes effect at once; wrap
    it in refreshed() to read the stored profiles less often. ``profile_year`` is the one
    that the profile was made for.
    """
    flat = readings.parse_flat_readings(messages)

    def process(rows: DataFrame, batch: Batch) -> None:
        flags = anomalies.flag_anomalies(
            rows, load_profile(), temp_threshold, wind_threshold, temp_sigmas, profile_year, ("latitude", "longitude")
        ).persist()
        # The first output that is written also counts the rows.
        seen, observation = _observed(flags, location_key(), F.col("is_anomaly"))
        try:
            if sink:
                found = anomalies.anomaly_messages(seen, carry=("latitude", "longitude"))
                keyed = readings.keyed_json(found, location_key(), ANOMALY_MESSAGE.fieldNames())
                send_messages(keyed, *sink, batch=batch, **options)
            if archive:
                found = anomalies.archive_rows(flags if sink else seen)
                archive_batch(found, f"{archive}/anomalies", ["country", "city", "year", "month"], batch)
            if statistics:
                if not sink and not archive:
                    seen.write.format("noop").mode("overwrite").save()
                archive_batch(_statistics_row(rows.sparkSession, observation), statistics, [], batch)
        finally:
            flags.unpersist()

    return _run_batches(flat, checkpoint, trigger, "append", process)


ARRIVALS = ("on_time", "late", "untimed")
_TIMES = "max_event_time timestamp"


def _seen_until(spark: SparkSession, path: str, batch: Batch) -> object:
    """The latest event time of the batches of this run before ``batch``; None before there is one."""
    if batch.number == 0:
        return None
    # Each batch keeps the latest time so far, so the one before is enough.
    before = Batch(batch.run, batch.number - 1).folder(f"{path}/_times")
    return spark.read.schema(_TIMES).json(before).first().max_event_time


def start_arrival_split(
    messages: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS, trigger: Trigger = EVERY_10_SECONDS
) -> StreamingQuery:
    """All flat readings, filed by whether they came on time.

    A reading is ``late`` if its event time is before the watermark that a window job with
    the same ``lateness`` has in that micro-batch: the latest event time of the batches
    before, less ``lateness``. One without a readable time, which enters no window either, is
    ``untimed``. Every reading is in exactly one of the folders, each batch once.
    """
    flat = readings.with_event_timestamp(readings.parse_flat_readings(messages))

    def process(rows: DataFrame, batch: Batch) -> None:
        spark = rows.sparkSession
        until = _seen_until(spark, path, batch)
        # Watermarks are kept in milliseconds.
        watermark = F.date_trunc("millisecond", F.lit(until).cast("timestamp")) - F.expr(f"interval {lateness}")
        late = F.coalesce(F.col("event_timestamp") < watermark, F.lit(False))
        arrival = F.when(F.col("event_timestamp").isNull(), ARRIVALS[2]).when(late, ARRIVALS[1]).otherwise(ARRIVALS[0])
        observation = Observation()
        seen = rows.observe(observation, F.max("event_timestamp").alias("latest"))
        archive_batch(seen.withColumn("arrival", arrival).drop("event_timestamp"), f"{path}/rows", ["arrival"], batch)
        latest = max((at for at in (until, observation.get["latest"]) if at is not None), default=None)
        archive_batch(spark.createDataFrame([(latest,)], _TIMES), f"{path}/_times", [], batch)
        # This batch may be tried again and then needs the one before; earlier ones are done with.
        manifest.remove(spark, Batch(batch.run, batch.number - 2).folder(f"{path}/_times"))

    return _run_batches(flat, checkpoint, trigger, "append", process)


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """The readings that start_arrival_split() has filed, with their ``arrival``."""
    schema = StructType(list(FLAT_READING.fields)).add("arrival", "string")
    return spark.read.schema(schema).json(f"{path}/rows")


def start_live_buffer(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    order: Callable[[], list[Column]],
    stream: str = "topic",
    limit: int = RETAINED,
    trigger: Trigger = EVERY_5_SECONDS,
) -> StreamingQuery:
    """The last ``limit`` messages of every stream, kept up to date while the job runs.

    Each micro-batch brings its own last messages, at most ``limit`` of a stream from each
    task, which meet the stored buffer; a manifest then names the new buffer and the batch
    that is in it, so a batch that is tried again changes nothing. ``order`` gives the
    newest first.
    """

    def process(rows: DataFrame, batch: Batch) -> None:
        spark = rows.sparkSession
        before = manifest.newest(spark, path)
        if before.covered.get(batch.run, -1) >= batch.number:
            return
        held = rows
        if before.parts:
            held = spark.read.schema(rows.schema).parquet(f"{path}/{before.parts[0]}").unionByName(rows)
        part = f"buffer-{batch.run}-{batch.number}"
        kept = retained(held, order(), stream, limit).drop("rank")
        kept.write.mode("overwrite").parquet(f"{path}/{part}")
        after = manifest.commit(spark, path, before, (part,), dict(before.covered) | {batch.run: batch.number})
        # Readers of the buffer before may still be at work; the one before that is let go.
        for name in listed(spark, f"{path}/buffer-*"):
            if name.rsplit("/", 1)[1] not in (*before.parts, *after.parts):
                manifest.remove(spark, name)

    return _run_batches(messages, checkpoint, trigger, "append", process)


def read_live_buffer(spark: SparkSession, path: str) -> DataFrame:
    """What the buffer holds now."""
    state = manifest.newest(spark, path)
    if not state.parts:
        raise ValueError(f"no buffer is stored in {path}")
    return spark.read.parquet(f"{path}/{state.parts[0]}")


class LateRows(StreamingQueryListener):
    """Rows that watermarks have dropped, by query id, over the whole run of each query."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def count_late_rows(spark: SparkSession) -> LateRows:
    """Count late rows of all queries from now on; progress reports reach the counter a moment later."""
    counter = LateRows()
    spark.streams.addListener(counter)
    return counter


def supervise(
    start: Callable[[], StreamingQuery], attempts: int, pause: float = 5.0, sleep: Callable[[float], None] = time.sleep
) -> None:
    """Run a query to its end, starting it again from its checkpoint after a failure."""
    for attempt in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return
        except StreamingQueryException:
            if attempt == attempts:
                raise
            sleep(pause)
