"""Daily rows as clustered Parquet, of which only what new documents touch is written anew.

The live files are listed in a table, by file and country with the first and last city,
and the manifest of the store names the table that counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar import schemas
from isobar.sinks import manifest
from isobar.storage import materialise

PLACE = ["country", "city"]
#: Days of a file, about.
ROWS = 1_000_000


def _root(base: str) -> str:
    return f"{base}/daily"


def _named(name: str) -> Column:
    return F.coalesce(name, F.lit("")).alias(name)


def _write(daily: DataFrame, root: str) -> str:
    """Write rows clustered by place and date into a new part; files are ranges of equal size.

    A large city spans many files, and a lookup skips those of other cities by their
    statistics. The row number spreads rows equal in all else; it is stable because
    ``daily`` must come straight from a scan of files. Their number grows with the rows, so
    that no task sorts more than about ROWS.
    """
    part = f"part-{uuid.uuid4().hex}"
    order = [*PLACE, "date"]
    numbered = daily.select(*schemas.DAILY.fieldNames(), F.monotonically_increasing_id().alias("_row"))
    files = -(-daily.count() // ROWS)
    many = files > int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = numbered.repartitionByRange(*([files] if many else []), *order, "_row")
    clustered = ranged.sortWithinPartitions(*order)
    clustered.drop("_row").write.parquet(f"{root}/{part}")
    return part


def _statistics(spark: SparkSession, root: str, part: str) -> DataFrame:
    """(file, country, first_city, last_city, days) of the files of a part."""
    rows = spark.read.schema(schemas.DAILY).parquet(f"{root}/{part}")
    file = F.concat(F.lit(f"{part}/"), F.col("_metadata.file_name")).alias("file")
    # By city first, which hashes: the least and greatest of texts alone would sort all rows of a task.
    cities = rows.groupBy(file, _named("country"), _named("city")).agg(F.count(F.lit(1)).alias("days"))
    return cities.groupBy("file", "country").agg(
        F.min("city").alias("first_city"), F.max("city").alias("last_city"), F.sum("days").alias("days")
    )


def _commit(spark: SparkSession, root: str, after: manifest.Manifest, files: DataFrame) -> None:
    table = f"_files-{uuid.uuid4().hex}"
    files.write.parquet(f"{root}/{table}")
    manifest.commit(spark, root, after, (table,))


def live_files(spark: SparkSession, base: str) -> DataFrame | None:
    """The table of the files that count; None where nothing was stored."""
    root = _root(base)
    state = manifest.newest(spark, root)
    return spark.read.parquet(f"{root}/{state.parts[0]}") if state.parts else None


def _names(files: DataFrame) -> list[str]:
    return [row["file"] for row in files.select("file").distinct().collect()]


def _read(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schemas.DAILY)
    return spark.read.schema(schemas.DAILY).parquet(*(f"{root}/{name}" for name in sorted(names)))


def stored_days(spark: SparkSession, base: str, place: tuple[str, str] | None = None) -> DataFrame:
    """All stored days, or of one city only the files that may hold it."""
    files = live_files(spark, base)
    if files is None:
        return spark.read.schema(schemas.DAILY).parquet(_root(base))
    if place is None:
        return _read(spark, _root(base), _names(files))
    country, city = place
    holding = files.where((F.col("country") == country) & F.lit(city).between(F.col("first_city"), F.col("last_city")))
    days = _read(spark, _root(base), _names(holding))
    return days.where((F.col("country") == country) & (F.col("city") == city))


def store_daily(daily: DataFrame, base: str) -> None:
    """Replace all stored days."""
    spark, root = daily.sparkSession, _root(base)
    before = manifest.newest(spark, root)
    # Stored first: the ranges are sampled from, and rows numbered over, files instead of a join or a parser.
    part = _write(materialise(daily.select(*schemas.DAILY.fieldNames()), "all-days"), root)
    _commit(spark, root, before, _statistics(spark, root, part))


def merge_daily(daily: DataFrame, base: str) -> None:
    """Replace the days of every city in ``daily``; all other cities' days stay.

    Only files whose range of cities holds one of them are read and written anew; a file
    that holds none stays as it is and keeps its name.
    """
    spark, root = daily.sparkSession, _root(base)
    before = manifest.newest(spark, root)
    if not before.parts:
        store_daily(daily, base)
        return
    fresh = materialise(daily.select(*schemas.DAILY.fieldNames()), "new-days")
    places = materialise(fresh.select(*(_named(name) for name in PLACE)).distinct(), "new-places")
    files = spark.read.parquet(f"{root}/{before.parts[0]}").alias("f")
    holds = (F.col("f.country") == F.col("p.country")) & F.col("p.city").between(F.col("first_city"), F.col("last_city"))
    touched = materialise(files.join(places.alias("p"), holds, "left_semi").select("file").distinct(), "touched")

    old = _read(spark, root, _names(touched)).alias("d")
    same = [F.coalesce(F.col(f"d.{name}"), F.lit("")) == F.col(f"p.{name}") for name in PLACE]
    kept = old.join(places.alias("p"), same, "left_anti")
    part = _write(materialise(kept.unionByName(fresh), "merged-days"), root)
    untouched = files.join(touched.alias("t"), F.col("f.file") == F.col("t.file"), "left_anti")
    _commit(spark, root, before, untouched.unionByName(_statistics(spark, root, part)))


def drop_dead_files(spark: SparkSession, base: str) -> int:
    """Remove data files that the last manifest does not list; nothing may be reading or writing."""
    root = _root(base)
    state = manifest.newest(spark, root)
    if not state.parts:
        return 0
    live = set(_names(spark.read.parquet(f"{root}/{state.parts[0]}")))
    dead = [name for name in manifest.listed(spark, f"{root}/part-*/*.parquet") if "/".join(name.rsplit("/", 2)[1:]) not in live]
    dead += [name for name in manifest.listed(spark, f"{root}/_files-*") if not name.endswith(f"/{state.parts[0]}")]
    for name in dead:
        manifest.remove(spark, name)
    return len(dead)
