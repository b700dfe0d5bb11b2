"""Climate profiles that are kept up to date: states of days that merge.

A state holds, by place, year and month, counts, sums, centred second moments, extremes and
alert days, and by city, year and month the days of every value of either mean, so that merged
quartiles are exact. The state of new days is added to what is there; days that are in a state
are never read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.calendar import with_month
from isobar.functions.deviations import share_percent
from isobar.operators.profiles import CITY_MONTH, PLACE, QUARTILES, grade_days, usable_days, validated_days

#: Size of the sketches that held the values before; what they could be off by is still tested against.
SKETCH = 4096

KEYS = [*PLACE, "year", "month"]
_SUMMED = ("temperature_mean", "temperature_max", "temperature_min", "windspeed_mean", "windspeed_max", "precipitation")
_RANKED = {"temp": "temperature_mean", "wind": "windspeed_mean"}
_SPREAD = ("temperature_mean", "windspeed_mean")
_LOWEST = ("temperature_mean", "temperature_min", "windspeed_mean", "windspeed_max")
_HIGHEST = ("temperature_mean", "temperature_max", "windspeed_mean", "windspeed_max")
_ALERTS = {f"{kind}_level_{grade}_days": (f"{kind}_alert", grade) for kind in ("wind", "heat") for grade in (1, 2)}


def _moments(days: DataFrame, scope: str) -> DataFrame:
    graded = grade_days(with_month(days))
    measures: list[Column] = [F.count(F.lit(1)).alias("total_days"), F.sum("has_alert").alias("days_with_alert")]
    measures += [F.count_if(F.col(alert) == grade).alias(name) for name, (alert, grade) in _ALERTS.items()]
    for name in _SUMMED:
        measures += [F.count(name).alias(f"n_{name}"), F.sum(name).alias(f"sum_{name}")]
    measures += [(F.var_pop(name) * F.count(name)).alias(f"spread_{name}") for name in _SPREAD]
    measures += [F.min(name).alias(f"min_{name}") for name in _LOWEST] + [F.max(name).alias(f"max_{name}") for name in _HIGHEST]
    return graded.groupBy(*KEYS).agg(*measures).select(F.lit(scope).alias("scope"), "*")


def moments_of(daily: DataFrame) -> DataFrame:
    """The states of the usable and of the validated days, by ``scope``."""
    return _moments(usable_days(daily), "usable").unionByName(_moments(validated_days(daily), "validated"))


def ranks_of(daily: DataFrame) -> DataFrame:
    """How many days have each value of either mean, over the days that quartiles() takes."""
    days = with_month(daily.dropna(subset=["temperature_mean", "windspeed_mean"]))
    means = F.array(
        *(F.struct(F.lit(measure).alias("measure"), F.col(name).alias("value")) for measure, name in _RANKED.items())
    )
    unfolded = days.select(*CITY_MONTH, F.inline(means))
    return unfolded.groupBy(*CITY_MONTH, "measure", "value").agg(F.count(F.lit(1)).alias("days"))


def merged_moments(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of the same keys as one; leaving a key out pools what it told apart."""
    added = ["total_days", "days_with_alert", *_ALERTS, *(f"{part}_{name}" for name in _SUMMED for part in ("n", "sum"))]
    measures = [F.sum(name).alias(name) for name in added]
    for name in _SPREAD:
        number, total = F.col(f"n_{name}"), F.col(f"sum_{name}")
        # Within the states, and between their means.
        between = F.sum(total * total / number) - F.sum(total) * F.sum(total) / F.sum(number)
        measures.append((F.sum(f"spread_{name}") + F.greatest(between, F.lit(0.0))).alias(f"spread_{name}"))
    measures += [F.min(f"min_{name}").alias(f"min_{name}") for name in _LOWEST]
    measures += [F.max(f"max_{name}").alias(f"max_{name}") for name in _HIGHEST]
    return states.groupBy("scope", *keys).agg(*measures)


def merged_values(states: DataFrame) -> DataFrame:
    return states.groupBy(*CITY_MONTH, "measure", "value").agg(F.sum("days").alias("days"))


def _mean(name: str) -> Column:
    return F.col(f"sum_{name}") / F.nullif(f"n_{name}", F.lit(0))


def _deviation(name: str) -> Column:
    number = F.col(f"n_{name}")
    return F.when(number > 1, F.sqrt(F.col(f"spread_{name}") / (number - 1)))


def _climatology() -> list[Column]:
    return [
        _mean("temperature_mean").alias("avg_temperature"), _mean("temperature_max").alias("avg_temperature_max"),
        _mean("temperature_min").alias("avg_temperature_min"), _mean("windspeed_mean").alias("avg_windspeed"),
        _mean("windspeed_max").alias("avg_windspeed_max"), _mean("precipitation").alias("avg_precipitation"),
        F.col("sum_precipitation").alias("total_precipitation"),
        *map(F.col, ("days_with_alert", "total_days", *_ALERTS)),
    ]


def _dispersion() -> list[Column]:
    shown = {
        "min_temperature": "min_temperature_mean", "max_temperature": "max_temperature_mean",
        "min_temperature_min": "min_temperature_min", "max_temperature_max": "max_temperature_max",
        "min_windspeed": "min_windspeed_mean", "max_windspeed": "max_windspeed_mean",
        "min_windspeed_max": "min_windspeed_max", "max_windspeed_max": "max_windspeed_max",
    }
    return [
        _deviation("temperature_mean").alias("std_temperature"), _deviation("windspeed_mean").alias("std_windspeed"),
        *(F.col(held).alias(name) for name, held in shown.items()),
    ]


def _probability() -> Column:
    return share_percent(F.col("days_with_alert"), F.col("total_days")).alias("alert_probability")


def enriched_from(moments: DataFrame) -> DataFrame:
    """What enriched_profile() gives over all the days of the states."""
    merged = merged_moments(moments.where("scope = 'validated'"), KEYS)
    return merged.select(*KEYS, *_climatology(), *_dispersion(), _probability())


def seasonal_from(moments: DataFrame) -> DataFrame:
    """What seasonal_profile() gives over all the days of the states."""
    keys = [*PLACE, "month"]
    merged = merged_moments(moments.where("scope = 'usable'"), keys)
    return merged.select(*keys, *_climatology(), _probability())


def quartiles_from(values: DataFrame) -> DataFrame:
    """What quartiles() gives: the first value up to which there are as many days as the rank asks for."""
    group = Window.partitionBy(*CITY_MONTH, "measure")
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged_values(values).withColumns({"upto": F.sum("days").over(upto), "of": F.sum("days").over(group)})
    columns = [
        F.min(F.when((F.col("measure") == measure) & (F.col("upto") >= F.ceil(F.col("of") * q)), F.col("value"))).alias(
            f"{measure}_{name}"
        )
        for measure in _RANKED
        for q, name in zip(QUARTILES, ("q25", "median", "q75"), strict=True)
    ]
    return ranked.groupBy(*CITY_MONTH).agg(*columns)


def full_profile_from(moments: DataFrame, values: DataFrame) -> DataFrame:
    """What full_profile() gives over all the days of the states."""
    return enriched_from(moments).join(quartiles_from(values), CITY_MONTH, "left")
