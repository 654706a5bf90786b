"""Coordinates written as ``(lat, lon)`` text, and the continent they fall in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sales_engine.functions.numbers import to_number

# Continent, latitude range, longitude range (inclusive). Boxes overlap; the first match wins.
CONTINENT_BOXES = (
    ("North America", (7, 83), (-170, -50)),
    ("South America", (-55, 15), (-90, -30)),
    ("Europe", (35, 71), (-25, 60)),
    ("Africa", (-35, 37), (-20, 55)),
    ("Asia", (0, 77), (25, 180)),
    ("Oceania", (-50, 10), (110, 180)),
)
NO_CONTINENT = "Unknown"


def parse_lat_lon(col: Column) -> tuple[Column, Column]:
    """Latitude and longitude as doubles, each NULL when its part is absent or malformed.

    The text loses its first character, the second part its last one, so the
    parentheses need not be of any particular kind.
    """
    parts = F.split(col, ",")
    second = F.get(parts, F.lit(1))
    latitude = F.get(parts, F.lit(0)).substr(F.lit(2), F.length(col))
    longitude = second.substr(F.lit(1), F.length(second) - 1)
    return to_number(latitude), to_number(longitude)


def continent(latitude: Column, longitude: Column) -> Column:
    """Name of the first box that holds the point; ``Unknown`` when none does or a coordinate is missing."""

    def add(rest: Column, box: tuple) -> Column:
        name, lats, lons = box
        return F.when(latitude.between(*lats) & longitude.between(*lons), F.lit(name)).otherwise(rest)

    return reduce(add, reversed(CONTINENT_BOXES), F.lit(NO_CONTINENT))
