"""Rule-based detection (CLS-1 to CLS-3, FLT-8, FLT-13 to FLT-15)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Geofence, Thresholds
from ..functions.geo import inside_box
from .alerts import alert_records
from .letters import or_broken

# Transponder code, name of its alert, severity; in order of rank.
EMERGENCY_CODES = (
    ("7500", "SQUAWK_HIJACK", 5),
    ("7600", "SQUAWK_RADIO_FAIL", 4),
    ("7700", "SQUAWK_EMERGENCY", 5),
)
OUTLIER_SEVERITY = 4
GEOFENCE_SEVERITY = 3

DETAIL = (
    "baro_altitude_ft",
    "geo_altitude_ft",
    "ground_speed_kt",
    "heading_deg",
    "vertical_rate_fpm",
    "squawk",
    "on_ground",
    "ingest_ts",
)


class Rule(NamedTuple):
    alert_type: str
    severity: int
    fires: Column


def implausible_flight(bounds: Thresholds) -> list[Rule]:
    """FLT-15: strictly above a bound; a null measurement never is."""
    return [
        Rule("ALT_OUTLIER", OUTLIER_SEVERITY, F.col("baro_altitude_ft") > bounds.altitude_ft),
        Rule("SPEED_OUTLIER", OUTLIER_SEVERITY, F.col("ground_speed_kt") > bounds.speed_kt),
        Rule("VS_OUTLIER", OUTLIER_SEVERITY, F.abs("vertical_rate_fpm") > bounds.vertical_rate_fpm),
    ]


def emergencies() -> list[Rule]:
    return [Rule(name, severity, F.col("squawk") == code) for code, name, severity in EMERGENCY_CODES]


def trespass(fence: Geofence) -> Rule:
    """FLT-13: every event inside the fence, not just the first one."""
    inside = inside_box(F.col("lat"), F.col("lon"), fence.lat_min, fence.lat_max, fence.lon_min, fence.lon_max)
    return Rule("GEOFENCE_ENTER", GEOFENCE_SEVERITY, inside)


def anomalous(bounds: Thresholds) -> Column:
    """Any rule but the geofence; true, false or, for lack of data, null."""
    emergency = F.col("squawk").isin(*[code for code, _, _ in EMERGENCY_CODES])
    return reduce(or_, [rule.fires for rule in implausible_flight(bounds)], emergency)


def rule_alerts(
    telemetry: DataFrame,
    bounds: Thresholds = Thresholds(),
    fence: Geofence = Geofence(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """At most one alert per event: the first rule that fires, in order of rank."""
    rules = [*emergencies(), *implausible_flight(bounds), trespass(fence)]
    verdict = F.coalesce(
        *[
            F.when(rule.fires, F.struct(F.lit(rule.alert_type).alias("type"), F.lit(rule.severity).alias("severity")))
            for rule in rules
        ]
    )
    fired = telemetry.withColumn("verdict", verdict)
    fired = fired.filter(or_broken(fired, F.col("verdict").isNotNull()))
    kind = F.col("verdict.type")
    return alert_records(
        fired, "spark_rules", kind, F.concat(F.lit("Rule alert: "), kind), F.col("verdict.severity"), DETAIL, keep
    )
