"""Queries over live readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar import schemas
from isobar.functions.codes import WEATHER_CODES, weather_label
from isobar.functions.places import full_place_name, safe_name, valid_coordinates
from isobar.operators import readings, serving, summaries, windows
from isobar.plans.registry import query, second_text
from isobar.plans.views import MESSAGES, READINGS, over
from isobar.sources import tables
from isobar.sources.documents import unfold_alerts
from isobar.sources.messages import first_messages
from isobar.storage import scratch_path


@query(
    over(
        READINGS,
        "select reading_id, location_key, temperature, windspeed, wind_alert_level, heat_alert_level from transformed",
    )
)
def alert_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transformed(spark, sf_dir).select(
        "reading_id", "location_key", "temperature", "windspeed", "wind_alert_level", "heat_alert_level"
    )


@query(
    over(
        READINGS,
        """
select kind, level, count(*) filter (where reached = level) as alerts
from (select 'wind' as kind, wind_alert_level as reached from transformed
      union all select 'heat', heat_alert_level from transformed)
     cross join (values ('level_1'), ('level_2')) levels(level)
group by kind, level""",
    )
)
def alert_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.alert_distribution(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        """
select count(*) filter (where wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0') as total_alerts,
       count(*) filter (where wind_alert_level <> 'level_0') as wind_alerts,
       count(*) filter (where heat_alert_level <> 'level_0') as heat_alerts
from transformed""",
    )
)
def alert_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.alert_totals(tables.transformed(spark, sf_dir))


_ALERTS = """
select reading_id, wind_alert_level, heat_alert_level,
       case when country is null or city is null then 'Lat_' || cast(latitude as varchar) else country end
         as archive_country,
       case when country is null or city is null then 'Lon_' || cast(longitude as varchar) else city end
         as archive_city
from transformed where wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0'"""


@query(
    over(
        READINGS,
        f"""
select *, translate(archive_country, '/ ', '__') as country_dir, translate(archive_city, '/ ', '__') as city_dir
from ({_ALERTS})""",
    )
)
def alerts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readings.alerts(tables.transformed(spark, sf_dir))
    return found.select(
        "reading_id",
        "wind_alert_level",
        "heat_alert_level",
        "archive_country",
        "archive_city",
        safe_name("archive_country").alias("country_dir"),
        safe_name("archive_city").alias("city_dir"),
    )


@query(
    over(
        READINGS,
        """
select country, city, temperature, windspeed, wind_alert_level, heat_alert_level, '2024-02-01T00:00:00.000000'
         as saved_timestamp
from transformed where wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0'""",
    )
)
def alert_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written as JSON lines and read back."""
    saved = F.lit("2024-02-01 00:00:00").cast("timestamp")
    lines = scratch_path(spark, "alerts")
    entries = readings.alert_entries(tables.transformed(spark, sf_dir), saved)
    entries.select("timestamp", "alert_data").write.json(lines)
    return unfold_alerts(spark.read.schema(schemas.ALERT_ENTRY).json(lines)).select(
        "country", "city", "temperature", "windspeed", "wind_alert_level", "heat_alert_level", "saved_timestamp"
    )


def _severe(kind: str) -> str:
    return over(
        READINGS,
        f"select reading_id, country, city, temperature, windspeed from transformed "
        f"where {kind}_alert_level = 'level_2'",
    )


_SEVERE_COLUMNS = ["reading_id", "country", "city", "temperature", "windspeed"]


@query(_severe("wind"))
def severe_wind_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.severe_alerts(tables.transformed(spark, sf_dir), "wind").select(*_SEVERE_COLUMNS)


@query(_severe("heat"))
def severe_heat_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.severe_alerts(tables.transformed(spark, sf_dir), "heat").select(*_SEVERE_COLUMNS)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_messages(tables.readings(spark, sf_dir))


@query(over(MESSAGES, "select reading_id, kind from sent"))
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = readings.classify_messages(_messages(spark, sf_dir))
    return tagged.select(F.col("offset").alias("reading_id"), "kind")


ROUND_TRIP_SQL = """
select reading_id, location_key as message_key,
       case when kind = 'reading' then strftime(event_time, '%Y-%m-%d %H:%M:%S') end as event_time,
       case when kind = 'reading' then country end as country,
       case when kind = 'reading' then city end as city,
       case when kind = 'reading' then latitude end as latitude,
       case when kind = 'reading' then longitude end as longitude,
       case when kind = 'reading' then temperature end as temperature,
       case when kind = 'reading' then windspeed end as windspeed,
       case when kind = 'reading' then weathercode end as weathercode,
       case when kind = 'reading' then wind_alert_level else 'level_0' end as wind_alert_level,
       case when kind = 'reading' then heat_alert_level else 'level_0' end as heat_alert_level,
       case when kind = 'reading' then 'open-meteo' end as data_source
from sent"""

ROUND_TRIP_COLUMNS = [
    "message_key", "event_time", "country", "city", "latitude", "longitude", "temperature",
    "windspeed", "weathercode", "wind_alert_level", "heat_alert_level", "data_source",
]


@query(over(MESSAGES, ROUND_TRIP_SQL))
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages to flat readings to messages and back."""
    parsed = readings.parse_messages(_messages(spark, sf_dir), schemas.RAW_READING, ["offset"])
    flat = readings.flatten_readings(parsed, "payload", ["offset"])
    sent = flat.select(
        F.col("message_key").alias("key"),
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(*schemas.FLAT_READING.fieldNames())).alias("value"),
    )
    back = readings.with_event_timestamp(readings.parse_flat_readings(sent, ["offset"]))
    back = back.withColumn("event_time", second_text("event_timestamp"))
    return back.select(F.col("offset").alias("reading_id"), *ROUND_TRIP_COLUMNS)


@query(
    over(
        MESSAGES,
        """
select cast(reading_id % 4 as integer) as partition, reading_id as "offset", location_key as key
from sent where kind <> 'text' order by 1, 2 limit 1000""",
    )
)
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1000 readable messages of the log, the limit a bounded reader is given."""
    return first_messages(_messages(spark, sf_dir), 1000).select("partition", "offset", "key")


@query(
    over(
        READINGS,
        """
select location_key as key, country, city, latitude, longitude, temperature, windspeed, weathercode,
       '2024-02-01T00:00:00.000000' as timestamp
from transformed where windspeed is not null and latitude between -90 and 90 and longitude between -90 * 2 and 90 * 2
""",
    )
)
def reading_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses wrapped as keyed raw readings; a response without wind has no current weather."""
    live = tables.readings(spark, sf_dir)
    landed = live.select(
        "latitude",
        "longitude",
        "city",
        "country",
        F.lit("").alias("location_name"),
        F.when(F.col("windspeed").isNotNull(), F.struct("temperature", "windspeed", "weathercode")).alias(
            "current_weather"
        ),
    )
    wrapped = readings.reading_envelopes(landed, "open-meteo", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    body = F.from_json("value", schemas.RAW_READING).alias("body")
    place, weather = "body.location", "body.current_weather"
    return wrapped.select("key", body).select(
        "key",
        f"{place}.country",
        f"{place}.city",
        f"{place}.latitude",
        f"{place}.longitude",
        f"{weather}.temperature",
        f"{weather}.windspeed",
        f"{weather}.weathercode",
        "body.timestamp",
    )


@query(
    """
select c_custkey, trim(n_name || ', ' || case when n_regionkey = 0 then '' else r_name end || ', ' ||
                       case when n_regionkey = 4 then '' else 'R' || n_regionkey end, ', ') as location_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
)
def place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full place names of all customers' nations; some lack their region or country."""
    named = (
        tables.table(spark, sf_dir, "customer")
        .join(tables.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(tables.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    region = F.when(F.col("n_regionkey") != 0, F.col("r_name"))
    country = F.when(F.col("n_regionkey") != 4, F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
    return named.select("c_custkey", full_place_name("n_name", region, country).alias("location_name"))


@query(
    """
select event_id as reading_id, value / 4 - 30 as latitude, value - 200 as longitude,
       value / 4 - 30 between -90 and 90 and value - 200 between -180 and 180 as valid
from events"""
)
def coordinate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates derived from event values, part of them off the globe."""
    placed = tables.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"),
        (F.col("value") / 4 - 30).alias("latitude"),
        (F.col("value") - 200).alias("longitude"),
    )
    return placed.withColumn("valid", valid_coordinates())


# One window metric per line, as SQL.
_METRICS = """
       avg(latitude) as latitude, avg(longitude) as longitude, avg(temperature) as avg_temperature,
       min(temperature) as min_temperature, max(temperature) as max_temperature,
       count(*) filter (where wind_alert_level <> 'level_0') as wind_alerts_count,
       count(*) filter (where heat_alert_level <> 'level_0') as heat_alerts_count,
       count(*) filter (where wind_alert_level = 'level_1') as wind_level_1_count,
       count(*) filter (where wind_alert_level = 'level_2') as wind_level_2_count,
       count(*) filter (where heat_alert_level = 'level_1') as heat_level_1_count,
       count(*) filter (where heat_alert_level = 'level_2') as heat_level_2_count,
       count(*) filter (where wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0') as total_alerts_count,
       count(*) as total_messages"""


def windows_sql(minutes: int, slide: int, by_place: bool = True) -> str:
    keys = "location_key, city, country" if by_place else "latitude, longitude"
    shown = (
        "location_key as location, city, country"
        if by_place
        else "cast(latitude as varchar) || ',' || cast(longitude as varchar) as location"
    )
    return over(
        READINGS,
        f"""
select strftime(opened, '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(opened + to_minutes({minutes}), '%Y-%m-%d %H:%M:%S') as window_end, {shown}, {_METRICS}
from (select *, time_bucket(to_minutes({slide}), event_time) - to_minutes(cast(back * {slide} as integer)) as opened
      from transformed cross join range({minutes // slide}) steps(back))
group by opened, {keys}""",
    )


def _windows(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({name: second_text(name) for name in ("window_start", "window_end")})


@query(f"""
select window_start, window_end, location, total_messages from ({windows_sql(5, 1)})
order by window_start desc, window_end, location limit 100""")
def latest_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _windows(windows.window_metrics(tables.transformed(spark, sf_dir)))
    return serving.newest_aggregates(states).select("window_start", "window_end", "location", "total_messages")


@query(windows_sql(5, 1))
def sliding_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(windows.window_metrics(tables.transformed(spark, sf_dir)))


@query(windows_sql(10, 2))
def sliding_metrics_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(windows.window_metrics(tables.transformed(spark, sf_dir), "10 minutes", "2 minutes"))


@query(windows_sql(5, 1, by_place=False))
def sliding_metrics_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(windows.window_metrics(tables.transformed(spark, sf_dir), by="coordinates"))


@query(windows_sql(5, 5))
def tumbling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(windows.window_metrics(tables.transformed(spark, sf_dir), "5 minutes", None))


@query(
    over(
        READINGS,
        "select city, count(*) as total_alerts from transformed "
        "where wind_alert_level in ('level_1', 'level_2') group by city",
    )
)
def regional_wind_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.wind_alerts_by_city(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        "select country, count(*) as total_alerts from transformed "
        "where heat_alert_level in ('level_1', 'level_2') group by country",
    )
)
def regional_heat_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.heat_alerts_by_country(tables.transformed(spark, sf_dir))


@query(over(READINGS, "select country, city, avg(temperature) as avg_temp from transformed group by country, city"))
def regional_avg_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.average_temperature_by_place(tables.transformed(spark, sf_dir))


_REGIONAL_SQL = """
select country, city, count(*) as total_alerts, avg(temperature) as avg_temp
from weather_transformed
where wind_alert_level in ('level_1', 'level_2') or heat_alert_level in ('level_1', 'level_2')
group by country, city"""


@query(over(READINGS, _REGIONAL_SQL.replace("weather_transformed", "transformed")))
def regional_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional aggregates as a user writes them, in SQL over a view of the readings."""
    return spark.sql(_REGIONAL_SQL.replace("weather_transformed", "{live}"), live=tables.transformed(spark, sf_dir))


@query(over(READINGS, "select country, weathercode, count(*) as readings from transformed group by all"))
def weathercode_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.weathercode_histogram(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        "select country, "
        + ", ".join(f"count(*) filter (where weathercode = {c}) as code_{c}" for c in summaries.CODES)
        + ", count(*) filter (where weathercode not between 0 and 99) as code_other"
        + " from transformed where weathercode is not null group by country",
    )
)
def weathercode_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.weathercode_matrix(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        """
select country, weathercode, readings, total from (
  select *, cast(sum(readings) over (partition by country) as bigint) as total,
         row_number() over (partition by country order by readings desc, weathercode) as rn
  from (select country, weathercode, count(*) as readings from transformed group by all))
where rn = 1""",
    )
)
def weathercode_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.weathercode_mode(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        "select reading_id, weathercode, case "
        + " ".join(f"when weathercode between {low} and {high} then '{text}'" for low, high, text in WEATHER_CODES)
        + " end as label from readings",
    )
)
def weathercode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = tables.readings(spark, sf_dir).withColumn("label", weather_label("weathercode"))
    return labelled.select("reading_id", "weathercode", "label")


def _series_sql(measure: str) -> str:
    return over(
        READINGS,
        f"""
select coalesce(city, 'Unknown') as city, country, strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, {measure},
       reading_id
from readings where {measure} is not null order by 1, 3, 5""",
    )


def _series(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    series = serving.measure_series(tables.readings(spark, sf_dir), measure, ("reading_id",))
    return series.withColumn("event_time", second_text("event_time"))


@query(_series_sql("temperature"))
def temperature_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir, "temperature")


@query(_series_sql("windspeed"))
def wind_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir, "windspeed")


def _newest_order() -> list:
    return [F.desc("event_time"), F.desc("reading_id")]


def _recent_sql(limit: int) -> str:
    return over(
        READINGS,
        f"""
select reading_id, country, city, temperature, windspeed from transformed
order by event_time desc, reading_id desc limit {limit}""",
    )


def _recent(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    newest = serving.newest(tables.transformed(spark, sf_dir), _newest_order(), limit)
    return newest.select("reading_id", "country", "city", "temperature", "windspeed")


@query(_recent_sql(10))
def recent_table_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, 10)


@query(_recent_sql(20))
def recent_table_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, 20)


@query(
    over(
        READINGS,
        """
select reading_id, case when reading_id % 7 <> 0 then strftime(event_time, '%Y-%m-%d %H:%M:%S') end as shown,
       true as stamped
from transformed""",
    )
)
def received_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh reading comes without a time and is shown at the moment it is received."""
    live = tables.transformed(spark, sf_dir)
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    sent = live.withColumn("event_time", F.when(F.col("reading_id") % 7 != 0, text))
    shown = readings.stamp_received(sent)
    late = F.col("event_time").isNull()
    return shown.select(
        "reading_id", F.when(~late, second_text("shown_time")).alias("shown"),
        (~late | (F.col("shown_time") == F.col("received_at"))).alias("stamped"),
    )


@query(
    over(
        READINGS,
        """
select reading_id, country, city, temperature, case when wind_alert_level <> 'level_0' then wind_alert_level end
         as wind_shown, case when heat_alert_level <> 'level_0' then heat_alert_level end as heat_shown
from transformed order by event_time desc, reading_id desc limit 100""",
    )
)
def latest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = serving.newest(tables.transformed(spark, sf_dir), _newest_order(), 100)
    return serving.recent_levels(recent).select(
        "reading_id", "country", "city", "temperature", "wind_shown", "heat_shown"
    )


@query(
    over(
        READINGS,
        """
select reading_id, country, city, cast(rn as integer) as rank from (
  select *, row_number() over (partition by country, city order by event_time desc, reading_id desc) as rn
  from transformed) where rn <= 5""",
    )
)
def latest_per_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = serving.newest_per_location(tables.transformed(spark, sf_dir), _newest_order(), 5)
    return newest.select("reading_id", "country", "city", "rank")


@query(
    over(
        READINGS,
        """
select weathercode, reading_id from (
  select *, row_number() over (partition by weathercode order by event_time desc, reading_id desc) as rn
  from readings) where rn <= 1000""",
    )
)
def retained_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 1000 readings of every stream, one stream per weather code."""
    live = tables.readings(spark, sf_dir)
    return serving.retained(live, _newest_order(), "weathercode").select("weathercode", "reading_id")


@query(over(READINGS, "select distinct country, city from transformed"))
def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.locations(tables.transformed(spark, sf_dir))


@query(
    over(
        READINGS,
        f"""
select archive_country as country, archive_city as city, count(*) as alerts from ({_ALERTS}) group by all""",
    )
)
def alerts_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readings.alerts(tables.transformed(spark, sf_dir))
    placed = found.select(F.col("archive_country").alias("country"), F.col("archive_city").alias("city"))
    return summaries.alerts_per_place(placed)


@query(
    over(
        READINGS,
        """
select 'NATION_1' as country, 'CITY_1' as city, count(*) as count from transformed
where country = 'NATION_1' and city = 'CITY_1' and (wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0')""",
    )
)
def city_alert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.city_count(readings.alerts(tables.transformed(spark, sf_dir)), "NATION_1", "CITY_1")


@query(
    over(
        READINGS,
        """
select count(*) as "rows", count(distinct location_key) as distinct_keys,
       count(*) filter (where wind_alert_level = 'level_2') as anomalies
from transformed""",
    )
)
def batch_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a micro-batch, here with severe wind as the flagged rows."""
    flagged = tables.transformed(spark, sf_dir).withColumn("flag", F.col("wind_alert_level") == "level_2")
    return summaries.batch_statistics(flagged, "location_key", "flag")
