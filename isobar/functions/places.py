"""Names, keys and coordinates of locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def coordinate_key(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    return F.concat(F.col(latitude).cast("string"), F.lit(","), F.col(longitude).cast("string"))


def location_key(
    country: str = "country", city: str = "city", latitude: str = "latitude", longitude: str = "longitude"
) -> Column:
    """country/city; concat is null as soon as one name is, and coordinates step in."""
    named = F.concat(F.col(country), F.lit("/"), F.col(city))
    return F.coalesce(named, coordinate_key(latitude, longitude))


def known(name: Column | str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.coalesce(name, F.lit(UNKNOWN))


def safe_name(name: Column | str) -> Column:
    """A name usable as a path segment: slash and space become underscore."""
    name = F.col(name) if isinstance(name, str) else name
    return F.translate(known(F.nullif(name, F.lit(""))), "/ ", "__")


def safe_text(name: str | None) -> str:
    """safe_name() of one name, for paths that are put together before a query runs."""
    return (name or UNKNOWN).replace("/", "_").replace(" ", "_")


def archive_place(
    country: str = "country", city: str = "city", latitude: str = "latitude", longitude: str = "longitude"
) -> dict[str, Column]:
    """Archive country and city; both fall back to coordinates when either is unknown."""
    nameless = (known(country) == UNKNOWN) | (known(city) == UNKNOWN)

    def coordinate(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.coalesce(F.col(column).cast("string"), F.lit("0")))

    return {
        "archive_country": F.when(nameless, coordinate("Lat_", latitude)).otherwise(F.col(country)),
        "archive_city": F.when(nameless, coordinate("Lon_", longitude)).otherwise(F.col(city)),
    }


def full_place_name(name: Column | str, region: Column | str, country: Column | str) -> Column:
    """"name, region, country" with commas and blanks trimmed off both ends."""
    parts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in (name, region, country)]
    joined = F.concat(parts[0], F.lit(", "), parts[1], F.lit(", "), parts[2])
    return F.trim(joined, F.lit(", "))


def valid_coordinates(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    inside = F.col(latitude).between(-90.0, 90.0) & F.col(longitude).between(-180.0, 180.0)
    return F.coalesce(inside, F.lit(False))
