"""Any feed to the canonical event (PRJ-2 to PRJ-11, FLT-3, AGG-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.instants import iso_seconds
from ..functions.text import blank_to_null, number, strip, truthy
from ..schemas import NORMALIZED
from ..sources.snapshots import STATE_FEED, explode_snapshots
from .letters import BROKEN, carries_letters, or_broken

# Feet per metre, knots and feet per minute per metre per second.
FEET_PER_METRE = 3.28084
KNOTS_PER_MPS = 1.94384
FPM_PER_MPS = 196.85

# Where a state vector holds each quantity.
STATE_POSITION = {
    "icao24": 0,
    "callsign": 1,
    "lon": 5,
    "lat": 6,
    "baro_altitude_m": 7,
    "on_ground": 8,
    "velocity_mps": 9,
    "heading_deg": 10,
    "vertical_rate_mps": 11,
    "geo_altitude_m": 13,
    "squawk": 14,
}


def normalize_objects(
    df: DataFrame,
    source: str | Column,
    observed_at: Column | None = None,
    keep: Sequence[str] = (),
    counters: str | Observation | None = None,
) -> DataFrame:
    """PRJ-2: raw aircraft objects, already in feet, knots and feet per minute."""
    altitude = F.col("alt_baro")
    fields = {
        "icao24": _identifier(F.col("hex")),
        "callsign": blank_to_null(strip(F.col("flight"))),
        "lat": number(F.col("lat")),
        "lon": number(F.col("lon")),
        "baro_altitude_ft": number(altitude),
        "geo_altitude_ft": number(F.col("alt_geom")),
        "ground_speed_kt": number(F.col("gs")),
        "heading_deg": number(F.col("track")),
        "vertical_rate_fpm": number(F.col("baro_rate")),
        "squawk": strip(F.col("squawk")),
        "category": F.col("category"),
        "on_ground": F.coalesce(F.lower(altitude) == "ground", F.lit(False)),
    }
    return _canonical(df, fields, source, observed_at, keep, counters)


def normalize_states(
    df: DataFrame,
    observed_at: Column | None = None,
    keep: Sequence[str] = (),
    counters: str | Observation | None = None,
) -> DataFrame:
    """PRJ-3: positional state vectors in metric units, as column ``state``.

    A vector that is too short, or a value that is no number, gives null in the
    fields concerned and leaves the other rows of its poll alone.
    """

    def at(quantity: str) -> Column:
        return F.get(F.col("state"), F.lit(STATE_POSITION[quantity]))

    def scaled(quantity: str, factor: float) -> Column:
        return number(at(quantity)) * F.lit(factor)

    fields = {
        "icao24": _identifier(at("icao24")),
        # An empty callsign is unknown, a blank one is known to be blank.
        "callsign": strip(blank_to_null(at("callsign"))),
        "lat": number(at("lat")),
        "lon": number(at("lon")),
        "baro_altitude_ft": scaled("baro_altitude_m", FEET_PER_METRE),
        "geo_altitude_ft": scaled("geo_altitude_m", FEET_PER_METRE),
        "ground_speed_kt": scaled("velocity_mps", KNOTS_PER_MPS),
        "heading_deg": number(at("heading_deg")),
        "vertical_rate_fpm": scaled("vertical_rate_mps", FPM_PER_MPS),
        "squawk": strip(at("squawk")),
        "category": F.lit(None).cast("string"),
        "on_ground": truthy(at("on_ground")),
    }
    return _canonical(df, fields, STATE_FEED, observed_at, keep, counters)


def normalize(
    snapshots: DataFrame,
    feed: str,
    observed_at: Column | None = None,
    keep: Sequence[str] = (),
    counters: str | Observation | None = None,
) -> DataFrame:
    """PRJ-11: envelopes of the configured feed; an unknown name is an object feed.

    With ``broken`` among the kept columns, lines that are no envelopes go on.
    """
    rows = explode_snapshots(snapshots, feed, with_broken=BROKEN in keep)
    if feed == STATE_FEED:
        return normalize_states(rows, observed_at, keep, counters)
    return normalize_objects(rows, feed, observed_at, keep, counters)


def _identifier(text: Column) -> Column:
    return blank_to_null(F.lower(strip(text)))


def _canonical(
    df: DataFrame,
    fields: dict[str, Column],
    source: str | Column,
    observed_at: Column | None,
    keep: Sequence[str],
    counters: str | Observation | None,
) -> DataFrame:
    fields = fields | {
        "event_time": iso_seconds(F.current_timestamp() if observed_at is None else observed_at),
        "source": F.lit(source),
    }
    events = df.select(*keep, *[fields[name].alias(name) for name in NORMALIZED.names])
    identified = F.col("icao24").isNotNull()
    if counters is not None:
        fetched = F.count_if(F.col(BROKEN).isNull()) if carries_letters(events) else F.count(F.lit(1))
        events = events.observe(counters, fetched.alias("fetched"), F.count_if(identified).alias("sent"))
    return events.filter(or_broken(events, identified))
