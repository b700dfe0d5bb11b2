"""One city, one day and one group of copies each hold a third of all rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from isobar.operators import ordinals, records, serving
from isobar.operators.readings import grade_alerts
from isobar.operators.windows import window_metrics
from isobar.storage import materialise

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third copies of one row, a third on one day of one city, a third spread out."""
    n = F.col("id")
    third = n % 3
    return materialise(
        spark.range(0, ROWS, 1, 6).select(
            F.lit("F").alias("country"),
            F.when(third < 2, "hot").otherwise(F.concat(F.lit("c"), (n % 40).cast("string"))).alias("city"),
            F.date_add(
                F.lit("2020-01-01").cast("date"), F.when(third == 0, 7).when(third == 1, 9).otherwise(n % 300).cast("int")
            ).alias("date"),
            F.when(third == 0, 5).otherwise(n % 1000).cast("double").alias("temperature_max"),
            F.when(third == 0, 5).otherwise(n % 500).cast("double").alias("temperature_min"),
            F.when(third == 0, 5).otherwise(n % 70).cast("double").alias("windspeed_max"),
            F.when(third == 0, 5).otherwise(n % 11).cast("double").alias("precipitation"),
            F.lit(1.0).alias("latitude"),
            F.lit(2.0).alias("longitude"),
        ),
        "skewed",
    )


@pytest.fixture(scope="module")
def duck(spark, skewed):
    files = [path.removeprefix("file:") for path in skewed.inputFiles()]
    connection = duckdb.connect()
    connection.execute(f"create view t as select * from read_parquet({files})")
    return connection


def rows_of(df):
    return sorted(tuple(map(str, row)) for row in df.collect())


def wanted(connection, sql):
    return sorted(tuple(map(str, row)) for row in connection.execute(sql).fetchall())


ORDER = ["date", "temperature_max", "temperature_min", "windspeed_max", "precipitation"]


def test_thinning(skewed, duck):
    thinned = serving.thin_series(skewed, ["country", "city"], ORDER).select("city", *ORDER)
    sql = f"""
select city, {", ".join(ORDER)} from (
  select *, row_number() over (partition by country, city order by {", ".join(ORDER)}) - 1 as pos,
         count(*) over (partition by country, city) as n from t) where pos % greatest(1, n // 1000) = 0"""
    assert rows_of(thinned) == wanted(duck, sql)


def test_a_hot_group_is_numbered_in_many_slices(skewed, monkeypatch):
    """No stored slice of the range-sorted rows holds much more than its share."""
    stored = {}

    def keep(df, label):
        stored[label] = materialise(df, label)
        return stored[label]

    monkeypatch.setattr(ordinals, "materialise", keep)
    numbered = ordinals.ordinal_in_group(skewed, ["country", "city"], ORDER)
    assert numbered.where("city = 'hot'").agg(F.max("ordinal")).first()[0] == ROWS * 2 // 3 - 1
    sizes = [row["count"] for row in stored["slices"].groupBy(F.expr("shiftright(_at, 33)")).count().collect()]
    assert len(sizes) > 1 and max(sizes) < ROWS / 2


@pytest.mark.parametrize(("k", "fan_in"), [(150, 64), (150, 2), (1500, 2)])
def test_top_k(skewed, duck, k, fan_in):
    order = [F.desc(name) for name in ("temperature_max", "date", "temperature_min", "windspeed_max", "precipitation")]
    top = records.top_k_per_group(skewed, ["city"], order, k, fan_in=fan_in)
    sql = f"""
select city, date, temperature_max, rn from (
  select *, row_number() over (partition by city order by temperature_max desc, date desc, temperature_min desc,
                               windspeed_max desc, precipitation desc) as rn from t) where rn <= {k}"""
    assert rows_of(top.select("city", "date", "temperature_max", "rank")) == wanted(duck, sql)


def test_levels_of_the_tree():
    assert [records.tree_levels(n, 64) for n in (1, 64, 65, 4096, 4097, 300_000)] == [0, 0, 1, 1, 2, 3]


def test_no_task_meets_more_than_its_part(spark, skewed, duck):
    """A large k over many tasks: every level's shuffle carries at most k rows of each task below it."""
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    k, fan_in, tasks = 5000, 4, 30
    many = skewed.repartition(tasks)
    order = [F.desc(name) for name in ("temperature_max", "date", "temperature_min", "windspeed_max", "precipitation")]
    top = records.top_k_per_group(many, ["city"], order, k, fan_in=fan_in, tasks=tasks)
    sql = f"""
select city, date, temperature_max, rn from (
  select *, row_number() over (partition by city order by temperature_max desc, date desc, temperature_min desc,
                               windspeed_max desc, precipitation desc) as rn from t) where rn <= {k}"""
    assert rows_of(top.select("city", "date", "temperature_max", "rank")) == wanted(duck, sql)
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == before
    plan = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Two levels of parts and the final one, each limited before its shuffle and after it.
    assert plan.count("WindowGroupLimit") == 2 * 3


def test_records(skewed, duck):
    found = records.climate_records(skewed).select("city", "max_temperature", "min_temperature", "total_days")
    sql = "select city, max(temperature_max), min(temperature_min), count(*) from t group by city"
    assert rows_of(found) == wanted(duck, sql)


def test_windows(spark, duck):
    live = spark.range(ROWS).select(
        F.lit("F").alias("country"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("city"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7200).alias("event_time"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        (F.col("id") % 50).cast("double").alias("temperature"),
        (F.col("id") % 30).cast("double").alias("windspeed"),
    )
    metrics = window_metrics(grade_alerts(live), "10 minutes", None)
    totals = metrics.groupBy("city").agg(F.sum("total_messages"), F.sum("wind_level_2_count"), F.max("max_temperature"))
    sql = f"""
select case when id % 3 < 2 then 'hot' else 'c' || (id % 40) end as city, count(*),
       count(*) filter (where id % 30 > 20), max(id % 50)::double
from range({ROWS}) r(id) group by 1"""
    assert rows_of(totals) == wanted(duck, sql)
