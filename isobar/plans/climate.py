"""Queries over daily history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.calendar import MONTH_NAMES, within_years
from isobar.operators import documents, history, profiles, records, serving, summaries
from isobar.plans.registry import day_text, query
from isobar.plans.views import COMPLETENESS, DAILY, ENRICHED, HISTORY, SEASONAL, WHOLE_HISTORY, over
from isobar.schemas import ENRICHED_DOCUMENT, HISTORY_DOCUMENT
from isobar.sinks import daily_store, profile_store
from isobar.sinks.writers import store_history
from isobar.sources import documents as stored_documents
from isobar.sources import tables
from isobar.storage import materialise, scratch_path

_DAY = [
    "country", "city", "latitude", "longitude", "temperature_mean", "temperature_max", "temperature_min",
    "windspeed_mean", "windspeed_max", "precipitation",
]


def _month_case(column: str, locale: str) -> str:
    return f"case {column} " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(MONTH_NAMES[locale], 1)) + " end"


def _rounded(df: DataFrame) -> DataFrame:
    """Round deviations, whose last bits depend on the order rows are combined in."""
    return df.withColumns({name: F.round(name, 6) for name in ("std_temperature", "std_windspeed")})


_AVERAGES = (
    "avg_temperature, avg_temperature_max, avg_temperature_min, avg_windspeed, avg_windspeed_max, "
    "avg_precipitation, alert_probability"
)
_DEVIATIONS = "round(std_temperature, 6) as std_temperature, round(std_windspeed, 6) as std_windspeed"
_COUNTS = (
    "days_with_alert, total_days, wind_level_1_days, wind_level_2_days, heat_level_1_days, heat_level_2_days, "
    "total_precipitation"
)
_EXTREMES = (
    "min_temperature, max_temperature, min_temperature_min, max_temperature_max, min_windspeed, max_windspeed, "
    "min_windspeed_max, max_windspeed_max"
)


@query(over(HISTORY, "select * exclude (o_orderkey, i) from history"))
def history_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows out of history documents in JSON text."""
    texts = tables.history_documents(spark, sf_dir)
    parsed = texts.select(F.from_json("value", HISTORY_DOCUMENT).alias("d")).select("d.*")
    return history.unfold_history(parsed)


def _stored_history(spark: SparkSession, sf_dir: str) -> str:
    """History documents of all six series, landed as files by country and city."""
    base = scratch_path(spark, "history")
    texts = tables.history_documents(spark, sf_dir, whole=True)
    store_history(texts.select(F.from_json("value", HISTORY_DOCUMENT).alias("d")).select("d.*"), base)
    return base


_WHOLE_DAYS = "select * exclude (o_orderkey, i) from history"


@query(over(WHOLE_HISTORY, _WHOLE_DAYS))
def history_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows out of stored history files."""
    return stored_documents.daily_history(spark, _stored_history(spark, sf_dir), "table")


@query(over(WHOLE_HISTORY, _WHOLE_DAYS + " where country = 'NATION_3' and city = 'CITY_1'"))
def history_files_of_a_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of one city alone are read."""
    return stored_documents.daily_history(spark, _stored_history(spark, sf_dir), "table", ("NATION_3", "CITY_1"))


@query(over(WHOLE_HISTORY, "select distinct replace(country, ' ', '_') as country, city from history"))
def stored_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities of a store, from the names of its folders."""
    return stored_documents.stored_places(spark, _stored_history(spark, sf_dir))


@query(
    over(
        HISTORY,
        """
select case when city = 'Unknown' then cast(latitude as varchar) || ',' || cast(longitude as varchar)
            else country || '/' || city end as key,
       o_orderkey, '1997-01-04' as start_date, '2007-01-02' as end_date, count(*) as days
from history group by all""",
    )
)
def history_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed daily arrays wrapped as history documents and sent as keyed messages."""
    landed = tables.history_documents(spark, sf_dir).select(
        "o_orderkey", F.from_json("value", HISTORY_DOCUMENT).alias("d")
    )
    place = "d.metadata.location"
    responses = landed.select(
        f"{place}.latitude",
        F.coalesce(f"{place}.longitude", F.lit(0.0)).alias("longitude"),
        F.coalesce(f"{place}.city", F.lit("Unknown")).alias("city"),
        f"{place}.country",
        F.col("o_orderkey").cast("string").alias("location_name"),
        "d.data.daily",
    )
    wrapped = history.wrap_history(responses, 10, F.lit("2007-01-02").cast("date"))
    sent = history.history_messages(wrapped)
    back = sent.select("key", F.from_json("value", HISTORY_DOCUMENT).alias("d"))
    period = F.col("d.metadata.period")
    return back.select(
        "key",
        F.col("d.metadata.location.location_name").cast("bigint").alias("o_orderkey"),
        period.start_date.alias("start_date"),
        period.end_date.alias("end_date"),
        F.size(F.filter("d.data.daily.time", lambda day: day != "")).cast("bigint").alias("days"),
    )


_SUMMARY = """count(*) as days, min(temperature_mean) as min_temperature, max(temperature_mean) as max_temperature,
       sum(precipitation) as total_precipitation from daily"""


@query(over(DAILY, f"select {_SUMMARY}"))
def history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.history_summary(tables.daily(spark, sf_dir))


@query(over(DAILY, f"select country, city, {_SUMMARY} group by country, city"))
def history_summary_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.history_summary(tables.daily(spark, sf_dir), ("country", "city"))


@query(
    over(
        DAILY,
        """
select country, city, count(*) as days, min(date) as first_day, max(date) as last_day from daily
where date between strftime(date '2000-12-31' - 2 * 365, '%Y-%m-%d') and '2000-12-31' group by country, city""",
    )
)
def history_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two years of 365 days up to the end of 2000."""
    recent = tables.daily(spark, sf_dir).where(within_years(F.col("date"), 2, F.lit("2000-12-31").cast("date")))
    return recent.groupBy("country", "city").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date").cast("string").alias("first_day"),
        F.max("date").cast("string").alias("last_day"),
    )


@query(
    over(
        DAILY,
        """
select date, country, city, temperature_max, windspeed_max, wind_alert, heat_alert,
       case when wind_alert > 0 or heat_alert > 0 then 1 else 0 end as has_alert
from graded""",
    )
)
def daily_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = profiles.grade_days(tables.daily(spark, sf_dir))
    return graded.select(
        day_text("date"), "country", "city", "temperature_max", "windspeed_max",
        "wind_alert", "heat_alert", "has_alert",
    )


def _record_sql(measure: str, direction: str) -> str:
    return f"row_number() over (partition by country, city order by {measure} {direction}, date desc)"


RECORDS_SQL = over(
    f"""{DAILY},
ranked as (
  select *, {_record_sql("temperature_max", "desc")} as hot, {_record_sql("temperature_min", "asc")} as cold,
         {_record_sql("windspeed_max", "desc")} as wind, {_record_sql("precipitation", "desc")} as rain
  from daily where windspeed_max is not null
)""",
    """
select country, city, any_value(latitude) as latitude, any_value(longitude) as longitude,
       max(date) filter (where hot = 1) as max_temp_date, max(temperature_max) as max_temperature,
       max(date) filter (where cold = 1) as min_temp_date, min(temperature_min) as min_temperature,
       max(date) filter (where wind = 1) as max_wind_date, max(windspeed_max) as max_windspeed,
       max(date) filter (where rain = 1) as max_precip_date, max(precipitation) as max_precipitation,
       count(*) as total_days
from ranked group by country, city""",
)


def _daily_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.climate_records(tables.daily(spark, sf_dir))


@query(RECORDS_SQL, name="records")
def climate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _daily_records(spark, sf_dir)
    return found.withColumns({name: day_text(name) for name in found.columns if name.endswith("_date")})


@query(RECORDS_SQL)
def record_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as stored documents, flattened again to compare them."""
    stored = documents.record_documents(_daily_records(spark, sf_dir))
    days = {
        "hottest_day": ("max_temp_date", "max_temperature", "temperature"),
        "coldest_day": ("min_temp_date", "min_temperature", "temperature"),
        "strongest_wind": ("max_wind_date", "max_windspeed", "windspeed"),
        "rainiest_day": ("max_precip_date", "max_precipitation", "precipitation"),
    }
    flat: list[Column] = []
    for day, (date, value, field) in days.items():
        flat += [F.col(f"records.{day}.date").alias(date), F.col(f"records.{day}.{field}").alias(value)]
    return stored.select("country", "city", "latitude", "longitude", *flat, "statistics.total_days")


_TOP_ORDER = (
    "temperature_max desc, date desc, temperature_mean, temperature_min, windspeed_mean, "
    "windspeed_max nulls first, precipitation"
)


@query(
    over(
        DAILY,
        f"""
select country, city, date, temperature_max, temperature_mean, windspeed_mean, precipitation,
       cast(rn as integer) as rank
from (select *, row_number() over (partition by country, city order by {_TOP_ORDER}) as rn from daily) where rn <= 3""",
    )
)
def records_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("temperature_max"), F.desc("date")]
    order += [F.asc(c) for c in ("temperature_mean", "temperature_min", "windspeed_mean")]
    order += [F.asc_nulls_first("windspeed_max"), F.asc("precipitation")]
    top = records.top_k_per_group(tables.daily(spark, sf_dir), ["country", "city"], order, 3)
    return top.select(
        "country", "city", day_text("date"), "temperature_max", "temperature_mean",
        "windspeed_mean", "precipitation", "rank",
    )


@query(
    over(
        SEASONAL,
        f"""
select country, city, latitude, longitude, month, {_month_case("month", "fr")} as month_name,
       {_COUNTS}, {_AVERAGES} from seasonal""",
    )
)
def seasonal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.named_months(profiles.seasonal_profile(tables.daily(spark, sf_dir)))


_ENRICHED_COLUMNS = (
    f"country, city, latitude, longitude, year, month, {_COUNTS}, {_EXTREMES}, "
    f"{_AVERAGES}, {_DEVIATIONS}"
)


@query(over(ENRICHED, f"select {_ENRICHED_COLUMNS} from enriched"))
def seasonal_profile_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.enriched_profile(tables.daily(spark, sf_dir)))


@query(over(ENRICHED, f"select {_ENRICHED_COLUMNS} from enriched order by country, city, year, month"))
def sorted_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.sorted_profile(profiles.enriched_profile(tables.daily(spark, sf_dir))))


@query(over(ENRICHED, "select * from quantiles"))
def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.quartiles(tables.daily(spark, sf_dir))


_QUARTILES = "temp_q25, temp_median, temp_q75, wind_q25, wind_median, wind_q75"


@query(
    over(
        ENRICHED,
        f"""
select {_ENRICHED_COLUMNS}, {_QUARTILES} from enriched left join quantiles using (country, city, year, month)""",
    )
)
def profile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.full_profile(tables.daily(spark, sf_dir)))


def _states(spark: SparkSession, sf_dir: str) -> str:
    """Days ingested in three parts, of which the first two are merged into one."""
    base = scratch_path(spark, "states")
    days = materialise(tables.daily(spark, sf_dir), "days")
    for third in range(3):
        profile_store.add_days(days.where(F.dayofyear("date") % 3 == third), base, f"third-{third}")
        if third == 1:
            profile_store.compact_state(spark, base)
    return base


@query(
    over(
        ENRICHED,
        f"""
select {_ENRICHED_COLUMNS}, {_QUARTILES} from enriched left join quantiles using (country, city, year, month)""",
    )
)
def profile_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile_store.stored_full_profile(spark, _states(spark, sf_dir)))


@query(over(SEASONAL, f"select country, city, latitude, longitude, month, {_COUNTS}, {_AVERAGES} from seasonal"))
def seasonal_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_store.stored_seasonal_profile(spark, _states(spark, sf_dir))


_DAY_COLUMNS = (
    "date, year, country, city, latitude, longitude, temperature_mean, temperature_max, temperature_min, windspeed_mean, "
    "windspeed_max, precipitation"
)


@query(over(DAILY, f"select {_DAY_COLUMNS} from daily where city = 'CITY_1' and latitude % 3 = 0 or year < 1998"))
def merged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of earlier years, then all days of some cities in place of what they had."""
    base = scratch_path(spark, "ingest")
    days = tables.daily(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    daily_store.store_daily(days.where("year < 1998"), base)
    daily_store.merge_daily(days.where("city = 'CITY_1' and latitude % 3 = 0"), base)
    return daily_store.stored_days(spark, base).select(*_DAY_COLUMNS.split(", "))


@query(over(DAILY, f"select {_DAY_COLUMNS} from daily where country = 'NATION_9' and city = 'CITY_1'"))
def stored_days_of_a_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city of the ingested days, from its files alone."""
    base = scratch_path(spark, "ingest")
    daily_store.store_daily(tables.daily(spark, sf_dir).withColumn("date", F.col("date").cast("string")), base)
    return daily_store.stored_days(spark, base, ("NATION_9", "CITY_1")).select(*_DAY_COLUMNS.split(", "))


@query(over(COMPLETENESS, "select * from checked"))
def profile_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = profiles.completeness(profiles.enriched_profile(tables.daily(spark, sf_dir)))
    return checked.withColumn("missing_months", F.array_join("missing_months", ","))


@query(over(COMPLETENESS, "select is_complete, count(*) as city_years from checked group by is_complete"))
def completeness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = profiles.completeness(profiles.enriched_profile(tables.daily(spark, sf_dir)))
    return profiles.completeness_summary(checked)


@query(
    over(
        ENRICHED,
        """
select count(distinct country || '/' || city) as cities, count(distinct country || '/' || city || '/' || year)
         as city_years
from enriched""",
    )
)
def profile_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.coverage(profiles.enriched_profile(tables.daily(spark, sf_dir)))


def _reject_sql() -> str:
    rules = {"missing date": "date is null", "missing year": "year is null"}
    for name in profiles.PHYSICAL_RANGES:
        rules[f"missing {name}"] = f"{name} is null"
    for name, (low, high) in profiles.PHYSICAL_RANGES.items():
        rules[f"{name} below {low:g}"] = f"{name} < {low:g}"
        rules[f"{name} above {high:g}"] = f"{name} > {high:g}"
    rules["any rule"] = (
        "not coalesce(temperature_mean between -50 and 60 and windspeed_max between 0 and 60 "
        "and windspeed_mean between 0 and 60, false)"
    )
    return " union all ".join(
        f"select '{rule}' as rule, count(*) filter (where {broken}) as days from daily" for rule, broken in rules.items()
    )


@query(over(DAILY, _reject_sql()))
def range_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.range_rejects(tables.daily(spark, sf_dir))


_EXTREME_SQL = """
select country, city, hottest_month, coldest_month, windiest_month, {names} from (
  select country, city, arg_max(month, (avg_temperature, -month)) as hottest_month,
         arg_min(month, (avg_temperature, month)) as coldest_month,
         arg_max(month, (avg_windspeed, -month)) as windiest_month
  from {table} group by country, city)"""
_EXTREME_NAMES = ", ".join(
    f"{_month_case(f'{kind}_month', 'fr-short')} as {kind}_month_name" for kind in ("hottest", "coldest", "windiest")
)


@query(over(SEASONAL, _EXTREME_SQL.format(names=_EXTREME_NAMES, table="seasonal")))
def extreme_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.extreme_months(profiles.seasonal_profile(tables.daily(spark, sf_dir)), ["country", "city"])


_NEWEST = "(select * from enriched semi join (select country, city, max(year) as year from enriched group by all) n "
_NEWEST += "using (country, city, year))"


@query(over(ENRICHED, _EXTREME_SQL.format(names=_EXTREME_NAMES, table=_NEWEST)))
def extreme_months_latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = serving.latest_year(profiles.enriched_profile(tables.daily(spark, sf_dir)))
    return profiles.extreme_months(newest, ["country", "city"])


@query(over(ENRICHED, f"select country, city, year, month, total_days from {_NEWEST}"))
def latest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = serving.latest_year(profiles.enriched_profile(tables.daily(spark, sf_dir)))
    return newest.select("country", "city", "year", "month", "total_days")


@query(
    over(
        ENRICHED,
        """
select country, city, month, year, avg_temperature, alert_probability
from (select *, row_number() over (partition by country, city, month order by year, latitude, longitude) as rn
      from enriched) where rn = 1""",
    )
)
def profile_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference_rows(spark, sf_dir, "earliest")


def _reference_rows(spark: SparkSession, sf_dir: str, year: str) -> DataFrame:
    picked = profiles.reference_profile(profiles.enriched_profile(tables.daily(spark, sf_dir)), year)
    return picked.select("country", "city", "month", "year", "avg_temperature", "alert_probability")


@query(
    over(
        ENRICHED,
        """
select country, city, month, year, avg_temperature, alert_probability
from (select *, row_number() over (partition by country, city, month order by year desc, latitude, longitude) as rn
      from enriched) where rn = 1""",
    )
)
def profile_reference_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference_rows(spark, sf_dir, "latest")


@query(
    over(
        ENRICHED,
        """
select country, city, month, array_to_string(list(year order by year), ',') as years,
       list(avg_temperature order by year)[1] as first_temperature, max(alert_probability) as alert_probability
from (select *, row_number() over (partition by country, city, month, year order by latitude, longitude) as rn
      from enriched) where rn = 1 group by country, city, month""",
    )
)
def profile_reference_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = profiles.reference_profile(profiles.enriched_profile(tables.daily(spark, sf_dir)), "as-of")
    each = lambda field: F.transform("years", lambda entry: entry[field])
    return picked.select(
        "country", "city", "month", F.array_join(each("year").cast("array<string>"), ",").alias("years"),
        F.col("years")[0]["avg_temperature"].alias("first_temperature"),
        F.array_max(each("alert_probability")).alias("alert_probability"),
    )


@query(
    over(
        SEASONAL,
        f"""
select country, city, count(*) as months, {_month_case("min(month)", "fr")} as first_month_name,
       sum(total_days)::bigint as total_days, 'spark-seasonal-analyzer' as source
from seasonal group by country, city""",
    )
)
def seasonal_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = documents.seasonal_documents(profiles.seasonal_profile(tables.daily(spark, sf_dir)))
    months = F.col("monthly_profiles")
    return stored.select(
        "country",
        "city",
        F.size(months).cast("bigint").alias("months"),
        months[0]["month_name"].alias("first_month_name"),
        F.aggregate(months, F.lit(0).cast("bigint"), lambda days, m: days + m["total_days"]).alias("total_days"),
        "source",
    )


@query(
    over(
        COMPLETENESS,
        f"""
select {_ENRICHED_COLUMNS}, {_QUARTILES}, {_month_case("month", "fr")} as month_name, months_count, missing_months,
       case when is_complete then 'complete' else 'incomplete' end as validation_status
from enriched left join quantiles using (country, city, year, month) join checked using (country, city, year)""",
    )
)
def enriched_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched profile documents sent as JSON messages, read back and unfolded."""
    profile = materialise(profiles.full_profile(tables.daily(spark, sf_dir)), "profile")
    stored = documents.enriched_documents(profile, profiles.completeness(profile))
    back = documents.read_as(documents.document_messages(stored), ENRICHED_DOCUMENT)
    months = documents.unfold_enriched(back, ("validation", "validation_status"))
    checked = {
        "months_count": F.col("validation.months_count"),
        "missing_months": F.array_join("validation.missing_months", ","),
    }
    return _rounded(months.withColumns(checked).drop("validation"))


@query(
    over(
        ENRICHED,
        """
select d.date, d.country, d.city, d.temperature_mean, d.windspeed_mean, temp_side, wind_side from (
  select daily.*,
         case when temperature_mean < temp_q25 - 1.5 * (temp_q75 - temp_q25) then 'low'
              when temperature_mean > temp_q75 + 1.5 * (temp_q75 - temp_q25) then 'high' end as temp_side,
         case when windspeed_mean < wind_q25 - 1.5 * (wind_q75 - wind_q25) then 'low'
              when windspeed_mean > wind_q75 + 1.5 * (wind_q75 - wind_q25) then 'high' end as wind_side
  from daily join quantiles using (country, city, year, month)) d
where temp_side is not null or wind_side is not null""",
    )
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = tables.daily(spark, sf_dir)
    outliers = profiles.iqr_outliers(days, profiles.quartiles(days))
    return outliers.select(
        day_text("date"), "country", "city", "temperature_mean", "windspeed_mean", "temp_side", "wind_side"
    )


_THIN_ORDER = (
    "date, temperature_mean, temperature_max, temperature_min, windspeed_mean, windspeed_max nulls first, precipitation"
)


@query(
    over(
        DAILY,
        f"""
select date, {", ".join(_DAY)} from (
  select *, row_number() over (partition by country, city order by {_THIN_ORDER}) - 1 as pos,
         count(*) over (partition by country, city) as n from daily)
where pos % greatest(1, n // 1000) = 0""",
    )
)
def downsampled_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["date", *(c for c in _DAY if c not in ("country", "city", "latitude", "longitude"))]
    thinned = serving.thin_series(tables.daily(spark, sf_dir), ["country", "city"], order)
    return thinned.select(day_text("date"), *_DAY)


@query(over(DAILY, f"select date, {', '.join(_DAY)} from daily where country = 'NATION_3' and city = 'CITY_1'"))
def city_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.city_rows(tables.daily(spark, sf_dir), "NATION_3", "CITY_1")
    return found.select(day_text("date"), *_DAY)
