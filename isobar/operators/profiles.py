"""Monthly climate profiles from daily observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.calendar import month_name, with_month
from isobar.functions.deviations import share_percent, tukey_fences
from isobar.functions.levels import DAILY_HEAT, DAILY_WIND
from isobar.operators.joins import lookup
from isobar.storage import materialise

PLACE = ["country", "city", "latitude", "longitude"]
CITY_MONTH = ["country", "city", "year", "month"]
CITY_YEAR = ["country", "city", "year"]

# Inclusive physical ranges a validated day must lie in.
PHYSICAL_RANGES = {
    "temperature_mean": (-50.0, 60.0),
    "windspeed_max": (0.0, 60.0),
    "windspeed_mean": (0.0, 60.0),
}

QUARTILES = (0.25, 0.5, 0.75)

#: Which year's profile a reading is compared with.
PROFILE_YEARS = ("earliest", "latest", "same", "as-of")

_MEASURED = [
    *PLACE, "date", "year", "temperature_mean", "temperature_max", "temperature_min", "windspeed_mean", "windspeed_max",
    "precipitation",
]


def usable_days(daily: DataFrame) -> DataFrame:
    """Days that have both means and a date."""
    return daily.dropna(subset=["temperature_mean", "windspeed_mean", "date"])


def in_physical_range() -> Column:
    """True, false, or null where a measurement is missing; a filter keeps only true."""
    checks = [F.col(name).between(low, high) for name, (low, high) in PHYSICAL_RANGES.items()]
    return checks[0] & checks[1] & checks[2]


def validated_days(daily: DataFrame) -> DataFrame:
    return usable_days(daily).where(F.col("year").isNotNull() & in_physical_range())


def range_rejects(daily: DataFrame) -> DataFrame:
    """How many days each validation rule turns away; a day can break several rules."""
    rules = {f"missing {name}": F.col(name).isNull() for name in ("date", "year", *PHYSICAL_RANGES)}
    for name, (low, high) in PHYSICAL_RANGES.items():
        rules[f"{name} below {low:g}"] = F.col(name) < low
        rules[f"{name} above {high:g}"] = F.col(name) > high
    rules["any rule"] = ~F.coalesce(
        in_physical_range() & F.col("date").isNotNull() & F.col("year").isNotNull(), F.lit(False)
    )
    counted = daily.agg(
        *(F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())),
    )
    pairs = F.array(
        *(F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("days")) for i, rule in enumerate(rules))
    )
    return counted.select(F.inline(pairs))


def grade_days(daily: DataFrame) -> DataFrame:
    """Daily alert grades 0/1/2 for wind and heat, and whether the day has any alert."""
    graded = daily.withColumns(
        {
            "wind_alert": DAILY_WIND.grade("windspeed_max"),
            "heat_alert": DAILY_HEAT.grade("temperature_max"),
        }
    )
    return graded.withColumn("has_alert", (F.greatest("wind_alert", "heat_alert") > 0).cast("int"))


def _climatology() -> dict[str, Column]:
    day_counts = {
        f"{kind}_level_{grade}_days": F.count_if(F.col(f"{kind}_alert") == grade)
        for kind in ("wind", "heat")
        for grade in (1, 2)
    }
    return {
        "avg_temperature": F.avg("temperature_mean"),
        "avg_temperature_max": F.avg("temperature_max"),
        "avg_temperature_min": F.avg("temperature_min"),
        "avg_windspeed": F.avg("windspeed_mean"),
        "avg_windspeed_max": F.avg("windspeed_max"),
        "avg_precipitation": F.avg("precipitation"),
        "total_precipitation": F.sum("precipitation"),
        "days_with_alert": F.sum("has_alert"),
        "total_days": F.count(F.lit(1)),
        **day_counts,
    }


def _dispersion() -> dict[str, Column]:
    return {
        "std_temperature": F.stddev_samp("temperature_mean"),
        "min_temperature": F.min("temperature_mean"),
        "max_temperature": F.max("temperature_mean"),
        "min_temperature_min": F.min("temperature_min"),
        "max_temperature_max": F.max("temperature_max"),
        "std_windspeed": F.stddev_samp("windspeed_mean"),
        "min_windspeed": F.min("windspeed_mean"),
        "max_windspeed": F.max("windspeed_mean"),
        "min_windspeed_max": F.min("windspeed_max"),
        "max_windspeed_max": F.max("windspeed_max"),
    }


def _profile(daily: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    grouped = grade_days(daily).groupBy(*keys).agg(*(m.alias(name) for name, m in measures.items()))
    return grouped.withColumn(
        "alert_probability", share_percent(F.col("days_with_alert"), F.col("total_days"))
    )


def seasonal_profile(daily: DataFrame) -> DataFrame:
    """Monthly climatology per place, all years pooled."""
    days = with_month(usable_days(daily))
    return _profile(days, [*PLACE, "month"], _climatology())


def enriched_profile(daily: DataFrame) -> DataFrame:
    """Per-year monthly profile with dispersion, from days that pass validation.

    ``year`` is taken as given, as the scan reads it off the date text.
    """
    days = with_month(validated_days(daily))
    return _profile(days, [*PLACE, "year", "month"], _climatology() | _dispersion())


def quartiles(daily: DataFrame) -> DataFrame:
    """Quartiles of mean temperature and wind per city, year and month: exact nearest ranks.

    Every task counts the distinct values of a group before the shuffle. What is held of a
    group are its values, as many as the resolution of a measurement allows, however many
    days have them. Pass validated_days(daily) to restrict the rows.
    """
    days = with_month(daily.dropna(subset=["temperature_mean", "windspeed_mean"]))
    ranks = ", ".join(f"{q}D" for q in QUARTILES)
    counted = days.groupBy(*CITY_MONTH).agg(
        F.expr(f"percentile_disc(array({ranks})) within group (order by temperature_mean)").alias("temp"),
        F.expr(f"percentile_disc(array({ranks})) within group (order by windspeed_mean)").alias("wind"),
    )
    return counted.select(
        *CITY_MONTH,
        *(
            F.col(measure)[i].alias(f"{measure}_{rank}")
            for measure in ("temp", "wind")
            for i, rank in enumerate(("q25", "median", "q75"))
        ),
    )


def full_profile(daily: DataFrame, quantile_scope: str = "all", unfold_once: bool = True) -> DataFrame:
    """Enriched profile with quartiles; their scope is "all" usable days or only "validated".

    The two aggregate over different days and keys, each of which reads the days. So the
    days are made once, whether by parsing documents or by joins, and the columns in use
    stored; without ``unfold_once``, for days that come straight from files, they are read
    in place.
    """
    days = materialise(daily.select(*_MEASURED), "days") if unfold_once else daily
    scope = {"all": days, "validated": validated_days(days)}[quantile_scope]
    return enriched_profile(days).join(quartiles(scope), CITY_MONTH, "left")


def completeness(profile: DataFrame) -> DataFrame:
    """Months present and missing per city and year.

    Months are gathered as bits of one integer: a primitive buffer that combines on
    the map side, however many profile rows a city has.
    """
    months = profile.groupBy(*CITY_YEAR).agg(F.expr("bit_or(shiftleft(1, month))").alias("bits"))
    missing = F.filter(
        F.sequence(F.lit(1), F.lit(12)),
        lambda month: F.expr("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1), month)) == 0,
    )
    counted = months.withColumn("months_count", F.coalesce(F.bit_count("bits"), F.lit(0)))
    return counted.select(
        *CITY_YEAR,
        "months_count",
        missing.alias("missing_months"),
        (F.col("months_count") == 12).alias("is_complete"),
    )


def completeness_summary(checked: DataFrame) -> DataFrame:
    return checked.groupBy("is_complete").agg(F.count(F.lit(1)).alias("city_years"))


def coverage(profile: DataFrame) -> DataFrame:
    """How many cities, and city-years where the profile has years, were analysed."""
    measures = [F.count_distinct("country", "city").alias("cities")]
    if "year" in profile.columns:
        measures.append(F.count_distinct(*CITY_YEAR).alias("city_years"))
    return profile.agg(*measures)


def sorted_profile(profile: DataFrame) -> DataFrame:
    """Profiles in reading order: by place, then year if there are years, then month."""
    return profile.orderBy(*(key for key in CITY_MONTH if key in profile.columns))


def named_months(profile: DataFrame, locale: str = "fr") -> DataFrame:
    return profile.withColumn("month_name", month_name("month", locale))


def extreme_months(profile: DataFrame, keys: list[str], locale: str = "fr-short") -> DataFrame:
    """Hottest, coldest and windiest month of each profile; the earlier month wins a tie."""
    early = -F.col("month")
    picks = {
        "hottest_month": F.max_by("month", F.struct("avg_temperature", early)),
        "coldest_month": F.min_by("month", F.struct("avg_temperature", "month")),
        "windiest_month": F.max_by("month", F.struct("avg_windspeed", early)),
    }
    known = profile.where(F.col("avg_temperature").isNotNull() & F.col("avg_windspeed").isNotNull())
    chosen = known.groupBy(*keys).agg(*(pick.alias(name) for name, pick in picks.items()))
    return chosen.withColumns({f"{name}_name": month_name(name, locale) for name in picks})


def reference_profile(profile: DataFrame, year: str = "earliest") -> DataFrame:
    """The profile each city and month is compared with.

    ``year`` picks the "earliest" or "latest" year per city and month, or keeps all of them:
    for "same" a row per year, for "as-of" one row per city and month whose ``years`` are
    the years' profiles in ascending order. Readings are matched by flag_anomalies() with
    the same ``profile_year``.
    """
    order = F.desc("year") if year == "latest" else F.asc("year")
    keys = ["country", "city", "month"] if year in ("earliest", "latest") else CITY_MONTH
    if year not in PROFILE_YEARS:
        raise ValueError(f"unknown profile year {year!r}, expected one of {PROFILE_YEARS}")
    first = Window.partitionBy(*keys).orderBy(order, "latitude", "longitude")
    chosen = (
        profile.where("month is not null and month <> 0")
        .withColumn("alert_probability", F.coalesce("alert_probability", F.lit(0.0)))
        .withColumn("rank", F.row_number().over(first))
        .where("rank = 1")
        .drop("rank")
    )
    if year != "as-of":
        return chosen
    # As many entries as a city has years of history: a bounded array.
    others = [name for name in chosen.columns if name not in CITY_MONTH]
    years = F.array_sort(F.collect_list(F.struct("year", *others)))
    return chosen.where("year is not null").groupBy("country", "city", "month").agg(years.alias("years"))


def iqr_outliers(daily: DataFrame, ranks: DataFrame) -> DataFrame:
    """Days outside the Tukey fences of their city, year and month."""
    fenced = lookup(with_month(daily), ranks, CITY_MONTH, "inner")
    outside = {}
    for measure, prefix in (("temperature_mean", "temp"), ("windspeed_mean", "wind")):
        low, high = tukey_fences(F.col(f"{prefix}_q25"), F.col(f"{prefix}_q75"))
        outside[f"{prefix}_side"] = F.when(F.col(measure) < low, "low").when(F.col(measure) > high, "high")
    return fenced.withColumns(outside).where("temp_side is not null or wind_side is not null")
