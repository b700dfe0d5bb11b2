"""Tables a dashboard reads: lookups, newest rows, series and thinned history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.levels import shown_level
from isobar.functions.places import known
from isobar.operators.ordinals import ordinal_in_group
from isobar.operators.records import top_k, top_k_per_group
from isobar.storage import materialise

RETAINED = 1000
CHART_POINTS = 1000


def city_rows(df: DataFrame, country: str, city: str) -> DataFrame:
    """Rows of one city by its exact names; pass the place to a reader to read its files alone."""
    return df.where((F.col("country") == country) & (F.col("city") == city))


def city_count(df: DataFrame, country: str, city: str) -> DataFrame:
    counted = city_rows(df, country, city).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.lit(country).alias("country"), F.lit(city).alias("city"), "count")


def locations(df: DataFrame) -> DataFrame:
    return df.select("country", "city").distinct()


def latest_year(profiles: DataFrame) -> DataFrame:
    """Rows of the newest year of every city; a city has twelve rows a year."""
    newest = F.max("year").over(Window.partitionBy("country", "city"))
    return profiles.withColumn("_newest", newest).where("year = _newest").drop("_newest")


def newest(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The newest ``limit`` rows, newest first: a top-k, not a full sort."""
    return top_k(df, order, limit)


def newest_aggregates(windows: DataFrame, limit: int = 100) -> DataFrame:
    """The newest window states, latest window first."""
    return newest(windows, [F.desc("window_start"), F.asc("window_end"), F.asc("location")], limit)


def newest_per_location(
    df: DataFrame, order: list[Column], limit: int, keys: tuple[str, ...] = ("country", "city")
) -> DataFrame:
    return top_k_per_group(df, list(keys), order, limit)


def retained(
    df: DataFrame, order: list[Column], stream: str | None = None, limit: int = RETAINED
) -> DataFrame:
    """What a bounded buffer holds: the last ``limit`` rows by arrival, per stream if given."""
    if stream is None:
        return newest(df, order, limit)
    return top_k_per_group(df, [stream], order, limit)


def measure_series(readings: DataFrame, measure: str, tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """One measure over time per city, sorted; rows without time or value are left out."""
    present = readings.dropna(subset=["event_time", measure])
    series = present.select(
        known("city").alias("city"), known("country").alias("country"), "event_time", measure, *tie_breakers
    )
    return series.orderBy("city", "event_time", *tie_breakers)


def recent_levels(readings: DataFrame) -> DataFrame:
    """Readings with level_0 labels blanked, as the recent table shows them."""
    return readings.withColumns({f"{kind}_shown": shown_level(f"{kind}_alert_level") for kind in ("wind", "heat")})


def thin_series(df: DataFrame, keys: list[str], order: list[str], points: int = CHART_POINTS) -> DataFrame:
    """Keep every n-th row of each series, n = max(1, floor(rows / points)).

    The first column of ``order`` is the day (or another value with few distinct ones
    per series). Rows are first only counted per series and day, which tells where each
    day starts in its series and whether it holds a row to keep at all. Only days that
    do are read again, and ordinal_in_group numbers their rows, whatever a day's size.
    """
    day, *rest = order
    rest = rest or [day]
    bucket = [*keys, day]
    counted = df.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_rows"))
    series = Window.partitionBy(*keys)
    earlier = series.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_step": F.greatest(F.lit(1), F.floor(F.sum("_rows").over(series) / points)),
        }
    )
    next_kept = F.col("_before") + F.pmod(-F.col("_before"), F.col("_step"))
    kept_days = materialise(placed.where(next_kept < F.col("_before") + F.col("_rows")), "days").alias("k")

    same = [F.col(f"d.{name}").eqNullSafe(F.col(f"k.{name}")) for name in bucket]
    candidates = df.alias("d").join(kept_days, same, "inner").select("d.*", "k._before", "k._step")
    numbered = ordinal_in_group(candidates, bucket, rest)
    return numbered.where((F.col("_before") + F.col("ordinal")) % F.col("_step") == 0).select(*df.columns)
