"""The streaming jobs: a source, pure transformations, a sink (STR-1 to STR-7).

All are append-only and, but for publication, free of shuffles, so their
parallelism is that of the bus. Each has its own checkpoint and can be stopped
and restarted alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..config import Area, Geofence, Index, Scoring, Thresholds, Topics
from ..operators.area import within_area
from ..operators.documents import alert_documents
from ..operators.features import model_features
from ..operators.history import to_archive
from ..operators.letters import BROKEN, to_bus_or_letters
from ..operators.normalize import normalize
from ..operators.routing import enrich_and_route, to_route_index, to_routed_bus
from ..operators.rules import rule_alerts
from ..operators.scoring import model_alerts, score
from ..operators.telemetry import parse_telemetry, telemetry_or_broken
from ..schemas import ALERT
from ..sources.archive import archive_stream
from ..sources.bus import Bus, writer_name
from ..sources.snapshots import read_snapshot_stream
from .publish import ensure_index, publish_batch

INGEST_COUNTERS = "ingest"
LANDING_COUNTERS = "landing"
PUBLISH_COUNTERS = "publish"
RULE_COUNTERS = "rules"
MODEL_COUNTERS = "score"


# Over all that is there, then stop. No trigger at all: batch after batch.
ONCE = {"availableNow": True}


def every(interval: str) -> dict[str, str]:
    """A batch per interval. Longer ones give the archive fewer, larger files."""
    return {"processingTime": interval}


def launch(writer: DataStreamWriter, name: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def routed_events(snapshots: DataFrame, feed: str, area: Area | None = None, with_broken: bool = False) -> DataFrame:
    """Landed snapshots as routed canonical events and, if asked for, the lines that are no envelopes.

    With an area, only what the feed would have answered for it; an event
    without a position is in no area.
    """
    keep = ["fetched_at", BROKEN] if with_broken else ["fetched_at"]
    events = normalize(snapshots, feed, F.col("fetched_at"), keep=keep, counters=INGEST_COUNTERS)
    if area is not None:
        events = within_area(events, feed, area)
    return enrich_and_route(events.withColumnRenamed("fetched_at", "@timestamp"))


def _counted(rows: DataFrame, counters: str) -> DataFrame:
    return rows.observe(counters, F.count(BROKEN).alias("unreadable"))


def ingest(
    spark: SparkSession,
    landing: str,
    feed: str,
    out: Bus,
    checkpoint: str,
    topics: Topics = Topics(),
    max_files: int | None = None,
    trigger: Mapping | None = None,
    area: Area | None = None,
) -> StreamingQuery:
    """SNK-4: all three routes in one pass, each record to the topic it names.

    A landed line is read once: it gives its many aircraft or, if it cannot be read,
    itself, which goes to the dead-letter topic and is counted.
    """
    routed = routed_events(read_snapshot_stream(spark, landing, max_files), feed, area, with_broken=True)
    records = to_routed_bus(_counted(routed, LANDING_COUNTERS), topics)
    return launch(out.write_stream(records, writer_name("ingest", checkpoint)), "ingest", checkpoint, trigger)


def index_routes(
    spark: SparkSession,
    landing: str,
    feed: str,
    path: str,
    checkpoint: str,
    prefix: str,
    max_files: int | None = None,
    trigger: Mapping | None = None,
    area: Area | None = None,
) -> StreamingQuery:
    """SNK-4: searchable copies of accepted and rejected events.

    A query of its own, so that files are written exactly once and a slow index
    does not hold up the bus.
    """
    copies = to_route_index(routed_events(read_snapshot_stream(spark, landing, max_files), feed, area), prefix)
    writer = copies.writeStream.format("parquet").option("path", path).partitionBy("index").outputMode("append")
    return launch(writer, "index_routes", checkpoint, trigger)


def alert_by_rules(
    spark: SparkSession,
    bus: Bus,
    out: Bus,
    checkpoint: str,
    topics: Topics = Topics(),
    bounds: Thresholds = Thresholds(),
    fence: Geofence = Geofence(),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Alerts to their topic; records that cannot be read to the dead-letter topic, counted."""
    telemetry = _counted(telemetry_or_broken(bus.read_stream(spark, [topics.telemetry], checkpoint)), RULE_COUNTERS)
    alerts = rule_alerts(telemetry, bounds, fence)
    records = to_bus_or_letters(alerts, ALERT.names, F.lit(topics.rule_alerts), topics, "spark_rules")
    return launch(out.write_stream(records, writer_name("alert_by_rules", checkpoint)), "alert_by_rules", checkpoint, trigger)


def alert_by_model(
    spark: SparkSession,
    bus: Bus,
    out: Bus,
    model: PipelineModel,
    checkpoint: str,
    topics: Topics = Topics(),
    levels: Scoring = Scoring(),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """As by rules: one pass for alerts and for what cannot be read."""
    telemetry = _counted(telemetry_or_broken(bus.read_stream(spark, [topics.telemetry], checkpoint)), MODEL_COUNTERS)
    alerts = model_alerts(score(model_features(telemetry), model), levels)
    records = to_bus_or_letters(alerts, ALERT.names, F.lit(topics.model_alerts), topics, "spark_ml")
    return launch(out.write_stream(records, writer_name("alert_by_model", checkpoint)), "alert_by_model", checkpoint, trigger)


def archive(
    spark: SparkSession, bus: Bus, path: str, checkpoint: str, topics: Topics = Topics(), trigger: Mapping | None = None
) -> StreamingQuery:
    history = to_archive(parse_telemetry(bus.read_stream(spark, [topics.telemetry], checkpoint)))
    return launch(archive_stream(history, path), "archive", checkpoint, trigger)


def publish(
    spark: SparkSession, bus: Bus, path: str, checkpoint: str, index: Index = Index(), trigger: Mapping | None = None
) -> StreamingQuery:
    """Alerts of all detectors to the index table. A failed write fails the
    batch, which is then retried; no document is skipped."""
    ensure_index(spark, path)
    documents = alert_documents(bus.read_stream(spark, index.topic_names(), checkpoint), index.prefix, PUBLISH_COUNTERS)
    writer = documents.writeStream.foreachBatch(partial(publish_batch, path=path))
    return launch(writer, "publish", checkpoint, trigger)
