"""Column-level rules: levels, places, calendar, weather codes, deviations."""
