"""The monitored area, as a disc or a box (FLT-11, FLT-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Area
from ..functions.geo import distance_nm, inside_box, near_box
from ..sources.snapshots import STATE_FEED
from .letters import or_broken


def within_disc(df: DataFrame, lat: float, lon: float, radius_nm: float) -> DataFrame:
    here = F.col("lat"), F.col("lon")
    near = df.filter(or_broken(df, near_box(*here, lat, lon, radius_nm)))
    return near.filter(or_broken(df, distance_nm(*here, lat, lon) <= radius_nm))


def within_box(df: DataFrame, lat: float, lon: float, half_lat: float, half_lon: float) -> DataFrame:
    inside = inside_box(F.col("lat"), F.col("lon"), lat - half_lat, lat + half_lat, lon - half_lon, lon + half_lon)
    return df.filter(or_broken(df, inside))


def within_area(df: DataFrame, feed: str, area: Area) -> DataFrame:
    """What the feed's own service would have answered for the area."""
    if feed == STATE_FEED:
        return within_box(df, area.lat, area.lon, area.half_lat, area.half_lon)
    return within_disc(df, area.lat, area.lon, area.radius_nm)
