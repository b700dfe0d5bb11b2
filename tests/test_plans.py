"""Plan shapes that decide whether a query scales."""

import re

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import profiles, readings, records, serving, summaries, windows
from isobar.operators.joins import lookup
from isobar.plans import registered, streams
from isobar.plans.anomaly import reference
from isobar.sources import tables
from isobar.storage import materialise

BATCH = sorted(name for name in registered() if not name.startswith("stream_s"))


@pytest.fixture(autouse=True)
def full_plans(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in BATCH if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = plan_of(registered()[name].run(spark, sf_dir))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scans_are_pruned(spark, sf_dir):
    plan = plan_of(summaries.history_summary(tables.daily(spark, sf_dir)))
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    columns = re.search(r"ReadSchema: struct<(.*?)>", lineitem).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"l_orderkey", "l_quantity", "l_suppkey"}


def test_level_filters_reach_the_scan(spark, sf_dir):
    """A test on the alert level is folded into a test on the measured value."""
    graded = readings.grade_alerts(
        tables.table(spark, sf_dir, "events").select(F.col("value").alias("temperature"), F.lit(0.0).alias("windspeed"))
    )
    plan = plan_of(readings.severe_alerts(graded, "heat"))
    assert "level_2" not in plan.split("Filter", 1)[1].split("\n", 1)[0]


@pytest.mark.parametrize(
    "operator",
    [
        lambda spark, sf: windows.window_metrics(tables.transformed(spark, sf)),
        lambda spark, sf: profiles.seasonal_profile(tables.daily(spark, sf)),
        lambda spark, sf: profiles.enriched_profile(tables.daily(spark, sf)),
        lambda spark, sf: records.climate_records(tables.daily(spark, sf)),
        lambda spark, sf: profiles.quartiles(tables.daily(spark, sf)),
        lambda spark, sf: summaries.weathercode_histogram(tables.readings(spark, sf)),
    ],
    ids=["windows", "seasonal", "enriched", "records", "quartiles", "histogram"],
)
def test_aggregates_combine_before_their_only_shuffle(operator, spark, sf_dir):
    plan = plan_of(operator(spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_" in plan.split("Exchange hashpartitioning", 1)[1]


def test_completeness_uses_a_primitive_buffer(spark, sf_dir):
    plan = plan_of(profiles.completeness(profiles.enriched_profile(tables.daily(spark, sf_dir))))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("k", [1, 1000, 5000])
def test_top_k_limits_groups_before_every_shuffle(k, spark, sf_dir):
    top = serving.newest_per_location(tables.readings(spark, sf_dir), [F.desc("event_time")], k)
    below = plan_of(top).split("Exchange hashpartitioning")[1:]
    assert len(below) == 2
    assert all("WindowGroupLimit" in part for part in below)


@pytest.mark.parametrize("limit", [10, 1000, 5000])
def test_newest_is_a_top_k(limit, spark, sf_dir):
    plan = plan_of(serving.newest(tables.readings(spark, sf_dir), [F.desc("event_time")], limit))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_payloads_are_parsed_once_under_filters(spark):
    sent = spark.createDataFrame([(None, "{}", None, "t", 0, 0)], schemas.MESSAGE)
    found = readings.alerts(readings.parse_flat_readings(sent)).where("temperature > 3 and city is not null")
    assert plan_of(found).count("from_json(") == 1


def test_quarantine_parses_once(spark):
    sent = spark.createDataFrame([(None, "{}", None, "t", 0, 0)], schemas.MESSAGE)
    for side in readings.split_valid(sent):
        assert plan_of(side).count("ParseJson") + plan_of(side).count("parseJson") == 1


def test_lookup_broadcasts_only_what_is_small(spark, sf_dir):
    facts = tables.readings(spark, sf_dir)
    table = facts.groupBy("country", "city").agg(F.avg("temperature").alias("mean"))
    assert "BroadcastHashJoin" in plan_of(lookup(facts, table, ["country", "city"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = plan_of(lookup(facts, table, ["country", "city"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_full_profile_reads_its_days_once(spark, sf_dir, monkeypatch):
    plans = []

    def keep(df, label):
        plans.append(plan_of(df))
        return materialise(df, label)

    monkeypatch.setattr(profiles, "materialise", keep)
    final = plan_of(profiles.full_profile(tables.daily(spark, sf_dir)))
    assert len(plans) == 1 and plans[0].count("lineitem.parquet") == 1 and "lineitem.parquet" not in final


def test_only_the_named_fields_are_parsed(spark):
    sent = spark.createDataFrame([(None, "{}", None, "t", 0, 0)], schemas.MESSAGE)
    found = windows.window_metrics(readings.parse_flat_readings(sent, fields=windows.USED))
    plan = plan_of(found)
    parsed = plan[plan.index("from_json(") :].split("\n", 1)[0]
    assert "StructField(temperature" in parsed and "weathercode" not in parsed and "winddirection" not in parsed


def test_a_session_of_others_shuffles_in_many_parts(spark, sf_dir):
    """What a task of a join sorts is bounded by its advisory size, not by the number of partitions set."""
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.unset(setting)
    tables.daily(spark, sf_dir)
    assert int(spark.conf.get(setting)) >= 400


def test_distinct_keys_make_their_profile_once(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(streams, "reference", lambda *args: made.append(args) or reference(*args))
    assert streams.stream_distinct_keys(spark, sf_dir).first().rows == 1000
    assert len(made) == 1
