"""Positions on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_NM = 3440.065


def inside_box(lat: Column, lon: Column, south: float, north: float, west: float, east: float) -> Column:
    """Inside or on the edge of the box."""
    return lat.between(south, north) & lon.between(west, east)


def distance_nm(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Great-circle distance by the haversine formula."""
    half_dlat = F.radians(lat - F.lit(lat0)) / 2
    half_dlon = F.radians(lon - F.lit(lon0)) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.lit(math.cos(math.radians(lat0))) * F.cos(F.radians(lat)) * F.pow(
        F.sin(half_dlon), 2
    )
    return 2 * EARTH_RADIUS_NM * F.asin(F.least(F.sqrt(chord), F.lit(1.0)))


def near_box(lat: Column, lon: Column, lat0: float, lon0: float, radius_nm: float) -> Column:
    """A cheap necessary condition for lying within ``radius_nm`` of the point.

    Plain comparisons, so a columnar scan can skip row groups by them. The
    longitude bound is left out where the disc touches a pole or the date line.
    """
    angle = radius_nm / EARTH_RADIUS_NM
    slack = 1e-6
    half_lat = math.degrees(angle) + slack
    near = lat.between(lat0 - half_lat, lat0 + half_lat)
    ratio = math.sin(min(angle, math.pi / 2)) / max(math.cos(math.radians(lat0)), 1e-12)
    if abs(lat0) + half_lat < 90 and ratio < 1:
        half_lon = math.degrees(math.asin(ratio)) + slack
        if abs(lon0) + half_lon < 180:
            near = near & lon.between(lon0 - half_lon, lon0 + half_lon)
    return near
