"""Distances, bearings, midpoints and bins on coordinates in degrees."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripworks.functions.numeric import ratio, round_half_even

# Fixed values.
EARTH_RADIUS_KM = 6371.0
GREAT_CIRCLE_RADIUS_KM = 6371.009
KM_PER_MILE = 1.609344


def _arc_km(half_chord_squared: Column, radius: float) -> Column:
    # Rounding can push the squared half chord of antipodes just over 1, where asin has no value.
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), half_chord_squared)))


def haversine_km(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance in the unit of ``radius``."""
    north = F.sin(F.radians(lat2 - lat1) / 2)
    east = F.sin(F.radians(lng2 - lng1) / 2)
    return _arc_km(
        north * north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east * east, radius
    )


def manhattan_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """East-west leg along the first point's parallel plus north-south leg along its meridian.

    On each leg one of the two haversine terms vanishes, so only the other is evaluated.
    """
    north = F.sin(F.radians(lat2 - lat1) / 2)
    east = F.cos(F.radians(lat1)) * F.sin(F.radians(lng2 - lng1) / 2)
    return _arc_km(east * east, EARTH_RADIUS_KM) + _arc_km(north * north, EARTH_RADIUS_KM)


def bearing_degrees(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Initial bearing in [-180, 180], north 0, east positive."""
    turn = F.radians(lng2 - lng1)
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    eastward = F.sin(turn) * F.cos(phi2)
    northward = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(turn)
    return F.degrees(F.atan2(eastward, northward))


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / 2


def great_circle_miles(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius_km: float = GREAT_CIRCLE_RADIUS_KM
) -> Column:
    return haversine_km(lat1, lng1, lat2, lng2, radius_km) / F.lit(KM_PER_MILE)


def location_bin(coordinate: Column, digits: int = 2) -> Column:
    return round_half_even(coordinate, digits)


def in_window(lat: Column, lng: Column, south: float, north: float, west: float, east: float) -> Column:
    return lat.between(south, north) & lng.between(west, east)


def grid_cell(
    lat: Column, lng: Column, south: float, west: float, step: float = 0.05, columns: int = 100
) -> Column:
    """Number of the square cell holding a point: a cluster id that needs no fitted model."""
    row = F.floor((lat - F.lit(south)) / F.lit(step))
    col = F.floor((lng - F.lit(west)) / F.lit(step))
    return row * F.lit(columns) + col


def speed(distance_km: Column, seconds: Column, unit: str = "m/s") -> Column:
    """Average speed; NULL where the trip lasted zero seconds."""
    if unit == "m/s":
        return ratio(F.lit(1000.0) * distance_km, seconds)
    if unit == "km/s":
        return ratio(distance_km, seconds)
    if unit == "km/h":
        return ratio(distance_km, seconds / F.lit(3600.0))
    raise ValueError(f"unknown speed unit {unit!r}")
