"""Alert grading of wind and heat."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RAISED = ("level_1", "level_2")
CALM = "level_0"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Scale:
    """Two cut points that grade a measurement 0, 1 or 2.

    ``first`` always belongs to grade 1. ``second`` belongs to grade 2 only when
    ``top_closed``; live wind and daily wind differ in exactly that.
    """

    first: float
    second: float
    top_closed: bool = False

    def _steps(self, value: Column | str, nan_is_missing: bool, outcomes: tuple) -> Column:
        # Plain branches with literal results: Catalyst folds later tests on the
        # outcome into them, so a filter on the level becomes a filter on the value.
        value = _col(value)
        if nan_is_missing:
            value = F.nullif(value, F.lit(float("nan")))
        low, middle, high = outcomes
        top = value >= self.second if self.top_closed else value > self.second
        return F.when(top, high).when(value >= self.first, middle).otherwise(low)

    def grade(self, value: Column | str, nan_is_missing: bool = False) -> Column:
        """Grade as int; a missing value grades 0, NaN sorts above everything."""
        return self._steps(value, nan_is_missing, (0, 1, 2))

    def level(self, value: Column | str, nan_is_missing: bool = False) -> Column:
        return self._steps(value, nan_is_missing, (CALM, *RAISED))


# Cut points in m/s and degrees Celsius.
LIVE_WIND = Scale(10.0, 20.0)
LIVE_HEAT = Scale(25.0, 35.0)
DAILY_WIND = Scale(10.0, 20.0, top_closed=True)
DAILY_HEAT = Scale(25.0, 35.0)

# Factors to m/s for feeds that deliver another wind unit.
WIND_UNITS = {"m/s": 1.0, "km/h": 1 / 3.6, "kn": 1852 / 3600, "mph": 0.44704}


def wind_in_ms(value: Column | str, unit: str = "m/s") -> Column:
    """Convert a wind speed to m/s, the unit the wind scales are stated in."""
    factor = WIND_UNITS[unit]
    return _col(value) if factor == 1.0 else _col(value) * factor


def raised(level: Column | str) -> Column:
    """True for level_1 and level_2; a missing level counts as level_0."""
    return F.coalesce(_col(level), F.lit(CALM)).isin(*RAISED)


def any_raised(wind: Column | str = "wind_alert_level", heat: Column | str = "heat_alert_level") -> Column:
    return raised(wind) | raised(heat)


def shown_level(level: Column | str) -> Column:
    """The label a table shows: nothing while calm."""
    level = _col(level)
    return F.when(level != CALM, level)
