"""Stores with manifests: merged ingests, profile states, compacted archives, writers cut off."""

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import profile_state, profiles
from isobar.sinks import archive, daily_store, manifest, profile_store
from isobar.sinks.writers import Batch, archive_batch
from isobar.sources.documents import ARCHIVES, archived_alerts, daily_history
from isobar.storage import scratch_path, scratch_scope


def days_of(spark, cities, first=0, count=40, temperature=10.0):
    start = datetime.date(2020, 1, 1)
    rows = []
    for c, city in enumerate(cities):
        for i in range(first, first + count):
            day = start + datetime.timedelta(days=i)
            t = temperature + (i * 7 + c * 3) % 11 / 4
            rows.append((str(day), day.year, city, "France", 48.0, 2.0, t + 4, t - 4, t, 0.5, (i % 50) / 2.0, (i % 30) / 2.0))
    return spark.createDataFrame(rows, schemas.DAILY)


def bag(df):
    return sorted(map(str, df.select(*schemas.DAILY.fieldNames()).collect()))


def live(spark, base):
    return {row.file for row in daily_store.live_files(spark, base).select("file").collect()}


def test_a_merge_leaves_other_files_alone(spark, folder):
    cities = [f"City{i:02d}" for i in range(12)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        daily_store.store_daily(days_of(spark, cities), folder)
        before = live(spark, folder)
        changed = days_of(spark, ["City03", "City99"], count=25, temperature=20.0)
        daily_store.merge_daily(changed, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    after = live(spark, folder)
    assert len(before) >= 3 and len(before & after) >= 2 and before - after
    others = days_of(spark, [c for c in cities if c != "City03"])
    kept = days_of(spark, cities).where("city <> 'City03'")
    assert others.count() == kept.count()
    assert bag(daily_store.stored_days(spark, folder)) == bag(kept.unionByName(changed))
    assert bag(daily_store.stored_days(spark, folder, ("France", "City03"))) == bag(changed.where("city = 'City03'"))
    assert daily_store.drop_dead_files(spark, folder) > 0
    assert bag(daily_history(spark, folder, "rows")) == bag(kept.unionByName(changed))
    assert daily_history(spark, folder, "rows", ("France", "Nowhere")).count() == 0


def test_a_merge_takes_missing_names_and_empty_input(spark, folder):
    nameless = days_of(spark, ["A", "B"]).withColumn("city", F.when(F.col("city") == "A", F.col("city")))
    daily_store.merge_daily(nameless, folder)  # the first merge stores all
    daily_store.merge_daily(nameless.limit(0), folder)
    assert bag(daily_store.stored_days(spark, folder)) == bag(nameless)
    daily_store.merge_daily(days_of(spark, [None], count=3), folder)
    assert bag(daily_store.stored_days(spark, folder)) == bag(nameless.where("city is not null").unionByName(days_of(spark, [None], count=3)))


def test_a_writer_that_is_cut_off_changes_nothing(spark, folder, monkeypatch):
    daily_store.store_daily(days_of(spark, ["A", "B"]), folder)

    def lost(*_):
        raise OSError("executor and driver gone")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "commit", lost)
        with pytest.raises(OSError, match="gone"):
            daily_store.merge_daily(days_of(spark, ["B"], count=2), folder)
    assert bag(daily_store.stored_days(spark, folder)) == bag(days_of(spark, ["A", "B"]))
    daily_store.merge_daily(days_of(spark, ["B"], count=2), folder)
    assert daily_store.stored_days(spark, folder).count() == 42


def test_manifests(spark, folder):
    first = manifest.commit(spark, folder, manifest.newest(spark, folder), ("a",))
    assert (first.number, manifest.newest(spark, folder).parts) == (1, ("a",))
    second = manifest.commit(spark, folder, first, ("a", "b"), {"run": 3})
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, folder, first, ("c",))
    # A writer lost while it wrote its manifest: the one before counts, and writing goes on.
    with open(f"{folder}/_manifests/{second.number + 1:010d}.json", "w") as broken:
        broken.write('{"parts": ["x"')
    assert manifest.newest(spark, folder) == second
    third = manifest.commit(spark, folder, second, ("d",))
    assert third.number == 4 and manifest.newest(spark, folder).covered == {"run": 3}
    last = third
    for number in range(30):
        last = manifest.commit(spark, folder, last, (f"p{number}",))
    assert manifest.newest(spark, folder) == last and last.parts == ("p29",)
    assert len(os.listdir(f"{folder}/_manifests")) < 2 * (manifest.KEPT + 5)


def rounded(profile):
    names = sorted(profile.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in (row[n] for n in names)]) for row in profile.collect())


def test_states_give_the_profile_of_all_days(spark, folder):
    every = days_of(spark, ["A", "B"], count=500).unionByName(days_of(spark, ["B"], count=1, temperature=400.0))
    every = every.unionByName(every.limit(1).withColumn("windspeed_max", F.lit(None).cast("double")))
    thirds = [every.where(F.pmod(F.xxhash64("date", "temperature_mean"), F.lit(3)) == n) for n in range(3)]
    assert profile_store.add_days(thirds[0], folder, "one")
    assert profile_store.add_days(thirds[1], folder, "two")
    assert not profile_store.add_days(thirds[1], folder, "two")
    profile_store.compact_state(spark, folder)
    assert not profile_store.add_days(thirds[0], folder, "one")
    assert profile_store.add_days(thirds[2], folder, "three")
    found = profile_store.stored_full_profile(spark, folder)
    assert rounded(found) == rounded(profiles.full_profile(every))
    assert rounded(profile_store.stored_seasonal_profile(spark, folder)) == rounded(profiles.seasonal_profile(every))


def test_days_in_a_state_are_not_read_again(spark, folder):
    path = f"{folder}/days"
    days_of(spark, ["A"]).write.parquet(path)
    profile_store.add_days(spark.read.schema(schemas.DAILY).parquet(path), folder)
    profile_store.add_days(days_of(spark, ["A"], first=40), folder)
    files = profile_store.stored_full_profile(spark, folder).inputFiles()
    assert files and not any(f"{path}/" in name for name in files)


def test_quartiles_of_a_large_group_stay_in_bounds(spark):
    """Many days in one month, in parts of very different ranges."""
    number = 60_000
    values = np.random.default_rng(3).permutation(number).astype(float)
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    days = rows.select(
        F.lit("2020-01-05").alias("date"), F.lit(2020).alias("year"), F.lit("A").alias("city"), F.lit("F").alias("country"),
        F.col("v").alias("temperature_mean"), F.lit(1.0).alias("windspeed_mean"),
    )
    parts = [profile_state.ranks_of(days.where(f"temperature_mean % 7 = {n}")) for n in range(7)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    row = profile_state.quartiles_from(states).first()
    bound = 2.5 / profile_state.SKETCH**0.9
    for name, rank in (("temp_q25", 0.25), ("temp_median", 0.5), ("temp_q75", 0.75)):
        assert abs(row[name] / number - rank) < bound


ALERT_SCHEMA, ALERT_DIRS = ARCHIVES["alerts"]


def alerts(spark, number, places=("Paris", "Lyon")):
    body = {"event_time": f"2024-01-01T00:{number:02d}:00Z", "temperature": 30.0 + number, "wind_alert_level": "level_0"}
    data = F.from_json(F.lit(str(body).replace("'", '"')), ALERT_SCHEMA["alert_data"].dataType)
    return spark.createDataFrame([(p,) for p in places], "city_dir string").select(
        F.lit("now").alias("timestamp"), data.alias("alert_data"), F.lit("France").alias("country_dir"), "city_dir"
    )


def fill(spark, base, run, numbers):
    for number in numbers:
        archive_batch(alerts(spark, number), f"{base}/alerts", ALERT_DIRS, Batch(run, number))


def shown(spark, base, place=None):
    found = archived_alerts(spark, base, place=place)
    return sorted((row.city_dir, row.temperature) for row in found.collect())


def compacted(spark, base, **options):
    return archive.compact_archive(spark, f"{base}/alerts", ALERT_SCHEMA, ALERT_DIRS, **options)


def test_compacting_while_batches_come_in(spark, folder, monkeypatch):
    fill(spark, folder, "r1", range(4))
    rows = shown(spark, folder)
    assert len(rows) == 8

    def lost(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(archive.manifest, "commit", lost)
        with pytest.raises(OSError, match="gone"):
            compacted(spark, folder)
    assert shown(spark, folder) == rows
    assert compacted(spark, folder) and not compacted(spark, folder)
    assert shown(spark, folder) == rows
    read = archived_alerts(spark, folder).select("temperature")
    assert sum("_generations" in name for name in read.inputFiles()) <= 2

    fill(spark, folder, "r1", [4, 5])
    fill(spark, folder, "r2", [0])
    more = sorted([*rows, *((p, 30.0 + n) for n in (4, 5, 0) for p in ("Paris", "Lyon"))])
    assert shown(spark, folder) == more
    # A batch that the job was writing when it was cut off is not finished.
    os.makedirs(f"{folder}/alerts/run_id=r2/batch_id=1")
    assert archive.finished_batches(spark, f"{folder}/alerts") == {"r1": 5, "r2": 0}
    assert compacted(spark, folder, full=True)
    assert len(manifest.newest(spark, f"{folder}/alerts").parts) == 1
    assert shown(spark, folder) == more
    assert shown(spark, folder, ("France", "Lyon")) == [row for row in more if row[0] == "Lyon"]
    # The last batch of a run may come again: it stays covered.
    fill(spark, folder, "r1", [5])
    assert shown(spark, folder) == more
    assert archive.drop_covered(spark, f"{folder}/alerts") > 0
    assert shown(spark, folder) == more
    fill(spark, folder, "r2", [1])
    assert len(shown(spark, folder)) == len(more) + 2


def test_an_archive_without_batches_is_not_compacted(spark, folder):
    alerts(spark, 1).write.partitionBy(*ALERT_DIRS).json(f"{folder}/alerts")
    assert not compacted(spark, folder)
    assert len(shown(spark, folder)) == 2


def test_scratch_tables_go_with_their_scope(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "inner")
        spark.range(3).write.parquet(path)
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
    kept = scratch_path(spark, "outer")
    spark.range(3).write.parquet(kept)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        1 / 0
    assert os.path.exists(kept.removeprefix("file://"))


def test_quartiles_of_a_large_group_are_exact(spark):
    """Merged states give every rank exactly, however many days and parts there are."""
    number = 60_000
    days = spark.range(number).select(
        F.lit("2020-01-05").alias("date"), F.lit(2020).alias("year"), F.lit("A").alias("city"), F.lit("F").alias("country"),
        F.pmod(F.col("id") * 7919, F.lit(number)).cast("double").alias("temperature_mean"),
        (F.col("id") % 7 / 4).alias("windspeed_mean"),
    )
    first, second = (profile_state.ranks_of(days.where(f"temperature_mean % 2 = {n}")) for n in range(2))
    row = profile_state.quartiles_from(first.unionByName(second)).first()
    assert (row.temp_q25, row.temp_median, row.temp_q75) == (14_999.0, 29_999.0, 44_999.0)
    assert (row.wind_q25, row.wind_median, row.wind_q75) == (0.25, 0.75, 1.25)


def test_files_are_ranges_of_bounded_size(spark, folder, monkeypatch):
    """More rows make more files, not larger ones."""
    monkeypatch.setattr(daily_store, "ROWS", 100, raising=False)
    days = days_of(spark, [f"City{i:02d}" for i in range(50)])
    daily_store.store_daily(days, folder)
    held = daily_store.live_files(spark, folder).groupBy("file").agg(F.sum("days").alias("days")).collect()
    assert len(held) > 10 and max(row.days for row in held) < 400
    assert bag(daily_store.stored_days(spark, folder)) == bag(days)


def test_the_list_of_files_sorts_no_days(spark, folder):
    days_of(spark, ["A", "B"]).write.parquet(f"{folder}/part-a")
    plan = daily_store._statistics(spark, folder, "part-a")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning")[-1]
    assert "HashAggregate" in below and "SortAggregate" not in below
