"""The alert record both detectors write (PRJ-17, PRJ-18, PRJ-20, PRJ-24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import expand_once
from ..schemas import ALERT
from .letters import BROKEN, carries_letters


def alert_records(
    events: DataFrame,
    detector: str,
    alert_type: Column,
    reason: Column,
    severity: Column,
    detail: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One alert per event, with the columns of ``detail`` nested under ``raw``;
    those of ``keep`` stay next to it, and broken text that the events carry."""
    keep = [*keep, BROKEN] if carries_letters(events) else keep
    return events.select(
        F.col("event_ts").alias("@timestamp"),
        F.current_timestamp().alias("alert_generated_at"),
        F.lit("flight_alert").alias("event_type"),
        F.lit(detector).alias("detector"),
        alert_type.alias("alert_type"),
        reason.alias("reason"),
        severity.cast("int").alias("severity"),
        "icao24",
        "callsign",
        "source",
        "lat",
        "lon",
        F.struct(*detail).alias("raw"),
        *keep,
    )


def parse_alerts(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-24: alerts of either detector off the bus, and whether each of the
    records is ``readable``, which is to say a JSON object. A field of a type
    that the contract does not know is null; the others keep their values."""
    value = F.col("value").cast("string")
    # Null for all that is no object.
    is_object = F.json_object_keys(value).isNotNull()
    parts = F.struct(F.from_json(value, ALERT).alias("alert"), is_object.alias("readable"))
    return expand_once(records, parts, keep).select(*keep, "alert.*", "readable")
