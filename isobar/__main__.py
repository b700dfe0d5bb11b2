"""Command line: python -m isobar JOB [options]."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isobar import batch, schemas
from isobar.functions.deviations import SIGMA_LIMIT, TEMPERATURE_LIMIT
from isobar.functions.levels import WIND_UNITS
from isobar.operators import anomalies, history, readings, serving, summaries
from isobar.operators.profiles import PROFILE_YEARS, extreme_months, sorted_profile
from isobar.session import build_session
from isobar.sinks import archive, daily_store, profile_store
from isobar.sinks.writers import send_messages, store_history
from isobar.sources import documents as stored
from isobar.sources.messages import KINDS, first_messages, message_stream, message_table
from isobar.storage import scratch_scope
from isobar.streaming import jobs

# Topic names of the running system.
TOPICS = {
    "raw": "weather_stream",
    "flat": "weather_transformed",
    "anomalies": "weather_anomalies",
    "records": "weather_records",
    "history": "weather_history_raw",
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="isobar", description="Weather telemetry jobs on Spark")
    jobs_of = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs_of.add_parser(name, help=text)
        added.add_argument("--kafka-servers", help="bootstrap servers when a topic is read or written")
        added.add_argument("--master", help="Spark master; left to spark-submit by default")
        return added

    def streaming(name: str, text: str, topic: str) -> argparse.ArgumentParser:
        added = job(name, text)
        added.add_argument("--source", choices=KINDS, default="kafka")
        added.add_argument("--input", default=TOPICS[topic], help="topic or folder of messages")
        added.add_argument("--checkpoint", required=True)
        added.add_argument("--from-beginning", action="store_true", help="start at the earliest message")
        added.add_argument("--once", action="store_true", help="stop when all input is read")
        added.add_argument("--attempts", type=int, default=5, help="starts before a failing job is given up")
        added.add_argument("--pause", type=float, default=5.0, help="seconds between two attempts")
        return added

    def output(added: argparse.ArgumentParser, topic: str) -> None:
        added.add_argument("--sink", choices=("kafka", "json", "parquet"), default="kafka")
        added.add_argument("--output", default=TOPICS[topic], help="topic or folder for messages")

    def batched(name: str, text: str, topic: str, states: bool = False) -> None:
        added = job(name, text)
        source = added.add_mutually_exclusive_group(required=True)
        source.add_argument("--history", help="base folder of history documents")
        if states:
            source.add_argument("--states", help="base folder of profile states, see add-days")
            added.add_argument("--quantile-scope", choices=("all", "validated"), default="all")
        added.add_argument("--layout", choices=("tree", "table", "rows"), default="tree")
        added.add_argument("--base", help="base folder to store documents in")
        added.add_argument("--skip-files", action="store_true")
        added.add_argument("--skip-messages", action="store_true")
        output(added, topic)

    transform = streaming("transform", "grade raw readings", "raw")
    output(transform, "flat")
    transform.add_argument("--event-time", choices=("processing", "payload", "received"), default="processing")
    transform.add_argument("--statistics", help="folder for per-batch statistics")
    transform.add_argument("--wind-unit", choices=sorted(WIND_UNITS), default="m/s", help="unit of the readings' wind")
    transform.add_argument("--nan-is-missing", action="store_true")
    transform.add_argument("--quarantine", help="folder for messages that are no JSON, which then do not go on")

    windows = streaming("windows", "window metrics per location", "flat")
    windows.add_argument("--output", required=True, help="folder for window states")
    windows.add_argument("--window", default="5 minutes")
    windows.add_argument("--slide", default="1 minute")
    windows.add_argument("--by", choices=("location", "coordinates"), default="location")
    windows.add_argument("--mode", choices=("update", "append"), default="update")

    archive = streaming("alerts", "archive alerts by country and city", "flat")
    archive.add_argument("--base", required=True)
    archive.add_argument("--unique", action="store_true", help="archive readings once that are delivered again")

    detect = streaming("detect", "flag anomalies against stored profiles", "flat")
    output(detect, "anomalies")
    detect.add_argument("--base", required=True, help="base folder of profiles and of the anomaly archive")
    detect.add_argument("--layout", choices=("tree", "table"), default="table")
    detect.add_argument("--profile-year", choices=PROFILE_YEARS, default="earliest")
    detect.add_argument("--refresh", type=float, default=600.0, help="seconds between readings of the profiles")
    detect.add_argument("--temp-threshold", type=float, default=TEMPERATURE_LIMIT)
    detect.add_argument("--wind-threshold", type=float, default=SIGMA_LIMIT)
    detect.add_argument("--temp-sigmas", type=float, help="standard deviations for temperature, if not those for wind")
    detect.add_argument("--statistics", help="folder for per-batch statistics")

    batched("records", "extreme days per city", "records")
    batched("seasonal", "monthly climatology per city", "records")
    batched("enrich", "validated yearly profiles with dispersion", "records", states=True)

    ingest = job("ingest", "store the days of history documents as clustered Parquet")
    ingest.add_argument("--merge", action="store_true", help="replace only the cities that the documents hold")
    learn = job("add-days", "add days to the profile states; days in them are not read again")
    learn.add_argument("--name", help="an ingest of this name counts once, however often it is run")
    for reader in (ingest, learn):
        reader.add_argument("--history", required=True, help="base folder of history documents")
        reader.add_argument("--layout", choices=("tree", "table"), default="tree")
        reader.add_argument("--base", required=True, help="base folder to store in")

    compact = job("compact", "gather the small files of a store; readers and writers may go on")
    compact.add_argument("kind", choices=("alerts", "anomalies", "profile-state"))
    compact.add_argument("--base", required=True)
    compact.add_argument("--full", action="store_true", help="write earlier generations anew, too")
    compact.add_argument("--drop", action="store_true", help="then remove what is no longer read")

    land = job("land-history", "wrap landed archive responses as history documents")
    land.add_argument("--responses", required=True, help="JSON folder of responses with place and daily arrays")
    land.add_argument("--base", help="base folder to store documents in")
    land.add_argument("--years", type=int, default=10)
    land.add_argument("--skip-files", action="store_true")
    land.add_argument("--skip-messages", action="store_true")
    output(land, "history")

    wrap = job("wrap-readings", "wrap landed current-weather responses as raw readings")
    wrap.add_argument("--responses", required=True, help="JSON folder of responses with place and current weather")
    output(wrap, "raw")

    show = job("show", "print a stored or summarised table")
    show.add_argument(
        "table",
        choices=(
            "messages", "alerts", "alert-levels", "weather-codes", "weather-code-matrix", "weather-code-modes",
            "cities", "city-alerts", "city-history", "city-records", "city-profile", "city-anomalies", "anomaly-types",
            "history-summary", "extreme-months", "newest-readings", "newest-anomalies", "newest-aggregates", "totals",
            "profiles",
        ),
    )
    show.add_argument("--country")
    show.add_argument("--city")

    sql = job("sql", "run a statement over weather_transformed, daily_history, profiles, alerts and anomalies")
    sql.add_argument("statement")
    sql.add_argument("--output", help="folder that gets all rows as Parquet; otherwise the first are printed")
    for reader in (show, sql):
        reader.add_argument("--base", help="base folder of stored documents")
        reader.add_argument("--layout", choices=("tree", "table", "rows"), default="table",
                            help="rows: daily history from ingested Parquet, all else as table")
        reader.add_argument("--source", choices=KINDS, default="kafka")
        reader.add_argument("--input", help="topic or folder of flat readings")
        reader.add_argument("--limit", type=int, default=20)
    return parser


def _kafka(args: argparse.Namespace) -> dict[str, str]:
    return {"kafka.bootstrap.servers": args.kafka_servers} if args.kafka_servers else {}


def _stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    start = "earliest" if args.from_beginning else "latest"
    options = _kafka(args) if args.source == "kafka" else {}
    return message_stream(spark, args.source, args.input, start, **options)


def _sink_options(args: argparse.Namespace) -> dict[str, str]:
    return _kafka(args) if args.sink == "kafka" else {}


def _start_stream(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    trigger: dict = {"trigger": {"availableNow": True}} if args.once else {}
    messages = _stream(spark, args)
    if args.job == "transform":
        return jobs.start_transform(
            messages, (args.sink, args.output), args.checkpoint, event_time=args.event_time,
            statistics=args.statistics, wind_unit=args.wind_unit, nan_is_missing=args.nan_is_missing,
            quarantine=args.quarantine, **trigger, **_sink_options(args),
        )
    elif args.job == "windows":
        return jobs.start_window_metrics(
            messages, args.output, args.checkpoint, args.window, args.slide, args.by, mode=args.mode, **trigger
        )
    elif args.job == "alerts":
        return jobs.start_alert_archive(messages, args.base, args.checkpoint, unique=args.unique, **trigger)

    def load() -> DataFrame:
        return batch.reference_profile(spark, args.base, args.layout, args.profile_year)

    return jobs.start_anomaly_detector(
        messages,
        jobs.refreshed(load, args.refresh),
        args.checkpoint,
        (args.sink, args.output),
        args.base,
        args.statistics,
        args.temp_threshold,
        args.wind_threshold,
        args.temp_sigmas,
        args.profile_year,
        **trigger,
        **_sink_options(args),
    )


def _run_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    base = None if args.skip_files else args.base
    sink = None if args.skip_messages else (args.sink, args.output)
    with scratch_scope(spark):
        if args.job == "enrich":
            profile = profile_store.stored_full_profile(spark, args.states) if args.states else None
            summary = batch.run_enriched(
                spark, args.history, base, sink, args.layout, args.quantile_scope, profile, **_sink_options(args)
            )
            summary.show()
        else:
            run = {"records": batch.run_records, "seasonal": batch.run_seasonal}[args.job]
            run(spark, args.history, base, sink, args.layout, **_sink_options(args))


def _store_days(spark: SparkSession, args: argparse.Namespace) -> None:
    days = stored.daily_history(spark, args.history, args.layout)
    with scratch_scope(spark):
        if args.job == "add-days":
            profile_store.add_days(days, args.base, args.name)
        elif args.merge:
            daily_store.merge_daily(days, args.base)
        else:
            daily_store.store_daily(days, args.base)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.kind == "profile-state":
        profile_store.compact_state(spark, args.base)
        return
    schema, partitions = stored.ARCHIVES[args.kind]
    path = f"{args.base}/{args.kind}"
    archive.compact_archive(spark, path, schema, partitions, args.full)
    if args.drop:
        archive.drop_covered(spark, path)


def _land(spark: SparkSession, args: argparse.Namespace) -> None:
    place = schemas.LOCATION.fields
    daily = schemas.HISTORY_DOCUMENT["data"].dataType["daily"]
    schema = schemas.record(**{field.name: field.dataType for field in place}, daily=daily.dataType)
    built = history.wrap_history(spark.read.schema(schema).json(args.responses), args.years)
    if not args.skip_files and args.base:
        store_history(built, args.base)
    if not args.skip_messages:
        send_messages(history.history_messages(built), args.sink, args.output, **_sink_options(args))


def _wrap(spark: SparkSession, args: argparse.Namespace) -> None:
    responses = spark.read.schema(schemas.CURRENT_RESPONSE).json(args.responses)
    send_messages(readings.reading_envelopes(responses, "open-meteo"), args.sink, args.output, **_sink_options(args))


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = _kafka(args) if args.source == "kafka" else {}
    return message_table(spark, args.source, args.input or TOPICS["flat"], **options)


def _flat(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return readings.parse_flat_readings(_messages(spark, args))


def _sql(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.input:
        _flat(spark, args).createOrReplaceTempView("weather_transformed")
    if args.base:
        for name, read in _STORED.items():
            layout = "table" if args.layout == "rows" and name != "daily_history" else args.layout
            try:
                read(spark, args.base, layout).createOrReplaceTempView(name)
            except AnalysisException as error:
                # A job that has not run yet has left no folder to read.
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
    return spark.sql(args.statement)


_STORED = {
    "daily_history": stored.daily_history,
    "profiles": stored.enriched_profiles,
    "alerts": stored.archived_alerts,
    "anomalies": stored.archived_anomalies,
}


def _table(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    documents_layout = "table" if args.layout == "rows" else args.layout

    place = (args.country, args.city) if args.table.startswith("city-") else None

    def of_city(df: DataFrame) -> DataFrame:
        return serving.city_rows(df, args.country, args.city)

    def alerts() -> DataFrame:
        return stored.archived_alerts(spark, args.base, documents_layout, place)

    def daily() -> DataFrame:
        return stored.daily_history(spark, args.base, args.layout, place)

    def profiles() -> DataFrame:
        return stored.enriched_profiles(spark, args.base, documents_layout, place)

    def anomaly_rows() -> DataFrame:
        return stored.archived_anomalies(spark, args.base, documents_layout, place)

    def cities() -> DataFrame:
        if args.layout == "table":
            return stored.stored_places(spark, args.base)
        return serving.locations(daily())

    def aggregates() -> DataFrame:
        return jobs.read_windows(spark, f"{args.base}/windows")

    tables = {
        "messages": lambda: first_messages(_messages(spark, args), args.limit),
        "alerts": lambda: readings.alerts(_flat(spark, args)),
        "alert-levels": lambda: summaries.alert_distribution(alerts()),
        "weather-codes": lambda: summaries.weathercode_histogram(_flat(spark, args)).orderBy("country", "weathercode"),
        "weather-code-matrix": lambda: summaries.weathercode_matrix(_flat(spark, args)).orderBy("country"),
        "weather-code-modes": lambda: summaries.weathercode_mode(_flat(spark, args)).orderBy("country"),
        "cities": lambda: cities().orderBy("country", "city"),
        "city-alerts": lambda: of_city(alerts()),
        "city-history": lambda: serving.thin_series(of_city(daily()), ["country", "city"], ["date"]).orderBy("date"),
        "city-records": lambda: of_city(
            stored.stored(spark, args.base, "records", schemas.RECORD_DOCUMENT, documents_layout, place)
        ),
        "city-profile": lambda: serving.latest_year(of_city(profiles())).orderBy("month"),
        "city-anomalies": lambda: of_city(anomaly_rows()),
        "newest-readings": lambda: serving.recent_levels(
            serving.newest(readings.with_event_timestamp(_flat(spark, args)), [F.desc("event_timestamp")], args.limit)
        ),
        "newest-anomalies": lambda: serving.newest(anomaly_rows(), [F.desc("event_time")], args.limit),
        "newest-aggregates": lambda: serving.newest_aggregates(aggregates(), args.limit),
        "totals": lambda: summaries.stream_totals(
            {"weather_anomalies": anomaly_rows(), "weather_aggregates": aggregates(), "alerts": alerts()}
        ),
        "profiles": lambda: sorted_profile(profiles()),
        "anomaly-types": lambda: anomalies.anomaly_type_counts(anomaly_rows(), ("country", "city")),
        "history-summary": lambda: summaries.history_summary(daily(), ("country", "city")),
        "extreme-months": lambda: extreme_months(serving.latest_year(profiles()), ["country", "city"]),
    }
    return tables[args.table]()


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"isobar-{args.job}", args.master)
    if args.job in ("transform", "windows", "alerts", "detect"):
        jobs.supervise(lambda: _start_stream(spark, args), args.attempts, args.pause)
    elif args.job in ("records", "seasonal", "enrich"):
        _run_batch(spark, args)
    elif args.job in ("ingest", "add-days"):
        _store_days(spark, args)
    elif args.job == "compact":
        _compact(spark, args)
    elif args.job == "land-history":
        _land(spark, args)
    elif args.job == "wrap-readings":
        _wrap(spark, args)
    else:
        shown = _sql(spark, args) if args.job == "sql" else _table(spark, args)
        if args.job == "sql" and args.output:
            shown.write.parquet(args.output)
        else:
            shown.show(args.limit, truncate=False)


if __name__ == "__main__":
    main()
