"""Coordinates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"-?[0-9.]+"


def printed_number(text: Column) -> Column:
    """A decimal number without trailing zeros, with at least one decimal digit."""
    trimmed = F.when(F.contains(text, F.lit(".")), F.rtrim(text, F.lit("0"))).otherwise(F.concat(text, F.lit(".")))
    return F.when(F.endswith(trimmed, F.lit(".")), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def coordinate(location: Column, position: int) -> Column:
    """The n-th number found in a location text (1 = latitude, 2 = longitude)."""
    return printed_number(F.get(F.regexp_extract_all(location, F.lit(NUMBER), F.lit(0)), F.lit(position - 1)))


def wkt_point(longitude: Column, latitude: Column) -> Column:
    """`POINT(lon lat)`, null when either coordinate is unknown."""
    return F.concat(F.lit("POINT("), longitude, F.lit(" "), latitude, F.lit(")"))


def wkt_points(places: Column) -> Column:
    """Points of an array of (longitude, latitude) structs; null for an empty array."""
    points = F.transform(places, lambda p: wkt_point(p["longitude"], p["latitude"]))
    return F.when(F.size(places) > 0, points)
