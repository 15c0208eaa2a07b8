"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the Earth in km (IUGG).
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    half_dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_dlng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    chord = (
        half_dlat * half_dlat
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlng * half_dlng
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
