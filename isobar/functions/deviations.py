"""Rules that compare an observation with what history expects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isobar.functions.levels import any_raised

# Degrees, standard deviations and percent.
TEMPERATURE_LIMIT = 5.0
SIGMA_LIMIT = 2.0
RARE_ALERT_PERCENT = 10
TUKEY_FACTOR = 1.5


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def temperature_flag(deviation: Column, std: Column, limit: float, sigmas: float) -> Column:
    """Off by more than ``limit`` degrees either way, or by more than ``sigmas`` deviations."""
    size = F.abs(deviation)
    return _sure(size > limit) | _sure(size > sigmas * std)


def wind_flag(deviation: Column, std: Column, sigmas: float) -> Column:
    """Only stronger wind counts; unusually calm days are never flagged."""
    return _sure(deviation > sigmas * std)


def alert_flag(wind_level: str, heat_level: str, probability: Column) -> Column:
    """An alert in a month whose history has alerts on fewer than one day in ten."""
    return any_raised(wind_level, heat_level) & _sure(probability < RARE_ALERT_PERCENT)


def anomaly_type(temperature: Column, wind: Column, alert: Column, temp_deviation: Column) -> Column:
    return (
        F.when(temperature & (temp_deviation > 0), "heat_wave")
        .when(temperature & (temp_deviation < 0), "cold_spell")
        .when(wind, "wind_storm")
        .when(alert, "unexpected_alert")
        .otherwise("normal")
    )


def tukey_fences(q25: Column, q75: Column, factor: float = TUKEY_FACTOR) -> tuple[Column, Column]:
    reach = (q75 - q25) * factor
    return q25 - reach, q75 + reach


def share_percent(part: Column, whole: Column) -> Column:
    return part / whole * 100
