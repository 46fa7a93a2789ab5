"""Great-circle distance and boxes on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0087714  # IUGG mean radius


def geodist(lat: Column, lon: Column, at_lat: float, at_lon: float) -> Column:
    """Haversine distance in km between (lat, lon) and a fixed point."""
    d_lat = F.radians(lat - F.lit(float(at_lat)))
    d_lon = F.radians(lon - F.lit(float(at_lon)))
    a = F.pow(F.sin(d_lat / 2), 2) + F.cos(F.radians(lat)) * F.lit(
        math.cos(math.radians(at_lat))
    ) * F.pow(F.sin(d_lon / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def bounding_box(lat: float, lon: float, radius_km: float) -> tuple[float, float, float, float]:
    """(south, north, west, east) in degrees; west > east where it crosses the date line."""
    angle = radius_km / EARTH_KM
    south, north = lat - math.degrees(angle), lat + math.degrees(angle)
    if south <= -90 or north >= 90 or angle >= math.pi / 2:
        return max(south, -90.0), min(north, 90.0), -180.0, 180.0
    ratio = math.sin(angle) / math.cos(math.radians(lat))
    if ratio >= 1:
        return south, north, -180.0, 180.0
    reach = math.degrees(math.asin(ratio))
    west, east = lon - reach, lon + reach
    if east - west >= 360:
        return south, north, -180.0, 180.0
    return south, north, (west + 180) % 360 - 180 if west < -180 else west, (east + 180) % 360 - 180 if east > 180 else east


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    south, north, west, east = box
    inside = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return lat.between(south, north) & inside
