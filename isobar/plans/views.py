"""The benchmark-table views of isobar.sources.tables, in SQL."""

READINGS = """
readings as (
  select event_id as reading_id, ts as event_time,
         'NATION_' || (user_id % 25) as country,
         case when user_id % 50 <> 7 then 'CITY_' || (user_id % 3) end as city,
         cast(user_id % 90 as double) as latitude, cast(user_id % 180 as double) as longitude,
         cast(floor(value) as double) / 2 as temperature,
         case when k <> 13 then cast(k as double) / 4 end as windspeed,
         case event_type when 'click' then 0 when 'view' then 3 when 'purchase' then 61
                         when 'signup' then 80 else 95 end as weathercode
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
),
transformed as (
  select *,
         case when windspeed > 20 then 'level_2' when windspeed >= 10 then 'level_1' else 'level_0' end
           as wind_alert_level,
         case when temperature > 35 then 'level_2' when temperature >= 25 then 'level_1' else 'level_0' end
           as heat_alert_level,
         case when country is not null and city is not null then country || '/' || city
              else cast(latitude as varchar) || ',' || cast(longitude as varchar) end as location_key
  from readings
)"""

DAILY = """
lines as (
  select cast(l_shipdate as date) as d, n_name as country, 'CITY_' || (c_custkey % 3) as city, n_nationkey as nk,
         case when n_nationkey % 2 = 0 then l_quantity * 0.5 - 5 else l_quantity * 1.5 - 20 end as t,
         l_partkey % (case when n_nationkey % 2 = 0 then 21 else 130 end) as w,
         l_linenumber as ln, l_suppkey as sk
  from lineitem join orders on l_orderkey = o_orderkey
       join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
),
daily as (
  select strftime(d, '%Y-%m-%d') as date, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
         country, city, cast(nk as double) as latitude, cast(nk * 2 as double) as longitude,
         cast(t as double) as temperature_mean, cast(t + ln * 0.5 as double) as temperature_max,
         cast(t - ln * 0.5 as double) as temperature_min, cast(w * 0.25 as double) as windspeed_mean,
         case when ln <> 7 then cast(w * 0.5 as double) end as windspeed_max,
         cast((sk % 40) * 0.25 as double) as precipitation
  from lines
),
graded as (
  select *,
         case when windspeed_max >= 20 then 2 when windspeed_max >= 10 then 1 else 0 end as wind_alert,
         case when temperature_max > 35 then 2 when temperature_max >= 25 then 1 else 0 end as heat_alert
  from daily
)"""

_CLIMATOLOGY = """
         avg(temperature_mean) as avg_temperature, avg(temperature_max) as avg_temperature_max,
         avg(temperature_min) as avg_temperature_min, avg(windspeed_mean) as avg_windspeed,
         avg(windspeed_max) as avg_windspeed_max, avg(precipitation) as avg_precipitation,
         sum(precipitation) as total_precipitation,
         count(*) filter (where wind_alert > 0 or heat_alert > 0) as days_with_alert, count(*) as total_days,
         count(*) filter (where wind_alert = 1) as wind_level_1_days,
         count(*) filter (where wind_alert = 2) as wind_level_2_days,
         count(*) filter (where heat_alert = 1) as heat_level_1_days,
         count(*) filter (where heat_alert = 2) as heat_level_2_days,
         count(*) filter (where wind_alert > 0 or heat_alert > 0) / count(*) * 100 as alert_probability"""

SEASONAL = (
    DAILY
    + f""",
seasonal as (
  select country, city, latitude, longitude, month, {_CLIMATOLOGY}
  from graded
  group by country, city, latitude, longitude, month
)"""
)

ENRICHED = (
    DAILY
    + f""",
enriched as (
  select country, city, latitude, longitude, year, month, {_CLIMATOLOGY},
         stddev_samp(temperature_mean) as std_temperature, min(temperature_mean) as min_temperature,
         max(temperature_mean) as max_temperature, min(temperature_min) as min_temperature_min,
         max(temperature_max) as max_temperature_max, stddev_samp(windspeed_mean) as std_windspeed,
         min(windspeed_mean) as min_windspeed, max(windspeed_mean) as max_windspeed,
         min(windspeed_max) as min_windspeed_max, max(windspeed_max) as max_windspeed_max
  from graded
  where temperature_mean between -50 and 60 and windspeed_max between 0 and 60 and windspeed_mean between 0 and 60
  group by country, city, latitude, longitude, year, month
),
quantiles as (
  select country, city, year, month,
         quantile_disc(temperature_mean, 0.25) as temp_q25, quantile_disc(temperature_mean, 0.5) as temp_median,
         quantile_disc(temperature_mean, 0.75) as temp_q75, quantile_disc(windspeed_mean, 0.25) as wind_q25,
         quantile_disc(windspeed_mean, 0.5) as wind_median, quantile_disc(windspeed_mean, 0.75) as wind_q75
  from daily
  group by country, city, year, month
)"""
)

COMPLETENESS = (
    ENRICHED
    + """,
checked as (
  select country, city, year, cast(count(distinct month) as integer) as months_count,
         array_to_string(list_filter(range(1, 13), lambda m: not list_contains(list(month), m)), ',')
           as missing_months,
         count(distinct month) = 12 as is_complete
  from enriched
  group by country, city, year
)"""
)

# Readings at the same month, day and time of other years: some have a profile, some only
# an earlier one, some none.
MOVED_MONTHS = 12 * 22, 10
MOVED_READINGS = READINGS.replace(
    "ts as event_time", f"ts - to_months({MOVED_MONTHS[0]} + 12 * (event_id % {MOVED_MONTHS[1]}) + event_id % 12) as event_time"
)


def flags(profile_year: str = "earliest", live: str = READINGS) -> str:
    """Readings against the profile of their city and month, of the chosen year."""
    by = "country, city, month" + (", year" if profile_year in ("same", "as-of") else "")
    order = "year desc" if profile_year == "latest" else "year"
    join = "asof left join" if profile_year == "as-of" else "left join"
    also = {"same": " and year(t.event_time) = r.year", "as-of": " and year(t.event_time) >= r.year"}.get(profile_year, "")
    return (
        live
        + ","
        + ENRICHED
        + f""",
reference as (
  select * from (
    select e.*, q.temp_median, q.wind_median,
           row_number() over (partition by {by} order by {order}, latitude, longitude) as rn
    from enriched e left join quantiles q using (country, city, year, month)
  ) where rn = 1
),
compared as (
  select t.reading_id, t.event_time, t.city, t.country, cast(year(t.event_time) as integer) as year,
         cast(month(t.event_time) as integer) as month, t.latitude, t.longitude,
         t.temperature as observed_temperature, r.avg_temperature as expected_temperature,
         t.temperature - r.avg_temperature as temp_deviation, t.windspeed as observed_windspeed,
         r.avg_windspeed as expected_windspeed, t.windspeed - r.avg_windspeed as wind_deviation,
         r.std_temperature as temp_std, r.std_windspeed as wind_std, r.temp_median, r.wind_median,
         r.alert_probability as expected_alert_probability,
         coalesce(abs(t.temperature - r.avg_temperature) > 5, false)
           or coalesce(abs(t.temperature - r.avg_temperature) > 2 * r.std_temperature, false) as temp_anomaly,
         coalesce(t.windspeed - r.avg_windspeed > 2 * r.std_windspeed, false) as wind_anomaly,
         coalesce((wind_alert_level <> 'level_0' or heat_alert_level <> 'level_0') and r.alert_probability < 10,
                  false) as alert_anomaly
  from transformed t {join} reference r
       on t.country = r.country and t.city = r.city and month(t.event_time) = r.month{also}
),
flags as (
  select *, temp_anomaly or wind_anomaly or alert_anomaly as is_anomaly,
         case when temp_anomaly and temp_deviation > 0 then 'heat_wave'
              when temp_anomaly and temp_deviation < 0 then 'cold_spell'
              when wind_anomaly then 'wind_storm'
              when alert_anomaly then 'unexpected_alert' else 'normal' end as anomaly_type
  from compared
),
messages as (
  select event_time, reading_id, city, country, 'temperature' as variable, observed_temperature as observed_value,
         expected_temperature as expected_value, anomaly_type from flags where temp_anomaly
  union all
  select event_time, reading_id, city, country, 'windspeed', observed_windspeed, expected_windspeed, anomaly_type
  from flags where wind_anomaly
  union all
  select event_time, reading_id, city, country, 'alert', 1.0, expected_alert_probability, anomaly_type
  from flags where alert_anomaly
)"""
    )


FLAGS = flags()

# The raw message of every reading, with the junk that replaces some.
MESSAGES = (
    READINGS
    + """,
sent as (
  select *, case reading_id % 10 when 1 then 'text' when 2 then 'other_json' when 3 then 'text' else 'reading' end
              as kind
  from transformed
)"""
)

HISTORY = """
history as (
  select o_orderkey, i, strftime(cast(o_orderdate as date) + cast(i as integer), '%Y-%m-%d') as date,
         cast(year(cast(o_orderdate as date) + cast(i as integer)) as integer) as year,
         n_name as country, case when o_orderkey % 7 <> 0 then 'CITY_' || (c_custkey % 3) else 'Unknown' end as city,
         cast(n_nationkey as double) as latitude, cast(n_nationkey * 2 as double) as longitude,
         cast((o_orderkey % 40 + i) * 0.5 + 2 as double) as temperature_max,
         cast((o_orderkey % 40 + i) * 0.5 - 2 as double) as temperature_min,
         case when o_orderkey % 3 <> 0 or i < 5 then cast((o_orderkey % 40 + i) * 0.5 as double) end
           as temperature_mean,
         cast(null as double) as precipitation, cast(null as double) as windspeed_max,
         cast((o_orderkey % 60 + i) * 0.25 as double) as windspeed_mean
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       cross join range(7) steps(i)
  where o_orderkey % 5 <> 0 or i < 6
)"""


# The same documents with all six series.
WHOLE_HISTORY = HISTORY.replace(
    "cast(null as double) as precipitation, cast(null as double) as windspeed_max",
    "cast((o_orderkey % 30 + i) * 0.25 as double) as precipitation, cast((o_orderkey % 50 + i) * 0.5 as double) as windspeed_max",
)


def over(views: str, statement: str) -> str:
    return f"with {views.strip()}\n{statement.strip()}"
