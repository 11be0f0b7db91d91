"""Enrichment, validation and routing (PRJ-12 to PRJ-15, FLT-4, CLS-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Topics
from ..functions.instants import instant, iso_millis
from .letters import BROKEN, to_bus_or_letters

# Fields of the transport, not of the event.
TRANSPORT_FIELDS = ("headers", "@version", "host", "url", "user_agent", "http", "event")

NO_POSITION = "missing_position"


def enrich_and_route(df: DataFrame) -> DataFrame:
    """Canonical events with their metadata and the column ``route``.

    A timestamp column ``@timestamp`` is taken as the time of arrival, else the
    current time is. Arrival is kept as ``ingest_ts``; ``@timestamp`` becomes
    the time of observation where that can be read.
    """
    arrival = F.col("`@timestamp`") if "@timestamp" in df.columns else F.current_timestamp()
    own_stream = F.col("stream") if "stream" in df.columns else F.lit(None).cast("string")
    own_tags = F.coalesce(F.col("tags"), F.array()) if "tags" in df.columns else F.array().cast("array<string>")
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    # A located event is marked as telemetry, unless it arrived with a mark.
    marked = F.when(placed & own_stream.isNull(), F.lit("telemetry"))
    accepted = marked.isNotNull() | (~placed & F.coalesce(own_stream == "telemetry", F.lit(False)))
    return df.drop(*TRANSPORT_FIELDS).withColumns(
        {
            "event_type": F.lit("flight_telemetry"),
            "ingest_ts": iso_millis(arrival),
            "@timestamp": iso_millis(F.coalesce(instant(F.col("event_time")), arrival)),
            "stream": F.coalesce(marked, own_stream),
            "location": F.when(placed, F.concat_ws(",", "lat", "lon")),
            "tags": F.when(~placed, F.concat(own_tags, F.array(F.lit(NO_POSITION)))).otherwise(
                F.when(F.size(own_tags) > 0, own_tags)
            ),
            "dlq_reason": F.when(~placed, F.lit(NO_POSITION)),
            "route": F.when(accepted, "telemetry").when(~placed, "dlq").otherwise("raw"),
        }
    )


def topic_of(route: Column, topics: Topics) -> Column:
    return F.when(route == "telemetry", topics.telemetry).when(route == "dlq", topics.dead_letter).otherwise(topics.raw)


def to_routed_bus(routed: DataFrame, topics: Topics = Topics()) -> DataFrame:
    """SNK-4: bus records that name their topic, so one pass serves all routes."""
    event = [name for name in routed.columns if name not in ("route", BROKEN)]
    return to_bus_or_letters(routed, event, topic_of(F.col("route"), topics), topics)


def to_route_index(routed: DataFrame, prefix: str) -> DataFrame:
    """SNK-4: the copies kept for searching; the raw route has none."""
    return routed.filter(F.col("route") != "raw").select(
        *[F.col(f"`{name}`") for name in routed.columns if name != "route"],
        F.concat(F.lit(f"{prefix}-"), F.col("route")).alias("index"),
    )
