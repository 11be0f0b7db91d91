"""The registered queries, one per operator or small group of operators.

Each reads the whole ``events`` table by way of a feed derived from it. Times
are returned as text, nested records as flat columns.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce, wraps

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Area, Thresholds, Topics, Training
from ..operators.alerts import parse_alerts
from ..operators.area import within_box, within_disc
from ..operators.bus_records import to_bus
from ..operators.documents import alert_documents, unmapped
from ..operators.features import class_balance, label_distribution, model_features, weak_labels, with_weights
from ..operators.history import to_archive
from ..operators.learning import (
    sample_predictions,
    save_model,
    source_indexer,
    split_history,
    train,
    vector_assembler,
)
from ..operators.normalize import normalize, normalize_objects, normalize_states
from ..operators.ranking import area_under_roc
from ..operators.routing import TRANSPORT_FIELDS, enrich_and_route, topic_of
from ..operators.rules import rule_alerts
from ..operators.scoring import model_alerts, score
from ..operators.telemetry import parse_telemetry
from ..schemas import MODEL_VECTOR
from ..session import names_below, remove_path, scratch, use_utc
from ..sources.archive import compact_archive, days_to_close, read_archive, read_history, rewrite_days, write_archive
from ..sources.bus import FileBus
from ..sources.snapshots import parse_snapshots
from ..streaming import jobs
from ..streaming.counters import CounterTable, RunningCounts
from ..streaming.publish import ensure_index, publish_batch, read_index
from ..streaming.together import Together
from . import feeds

Query = Callable[[SparkSession, str], DataFrame]

CONFIGURED_FEEDS = ("adsbfi", "airplaneslive", "opensky", "unheard-of")
DISC = (41.9, 12.5, 20.0)
BOX = (41.9, 12.5, 3.0, 4.0)
ONE_DAY = date(2024, 1, 15)
SMALL_AREA = {"AREA_DIST_NM": "20"}

_REGISTRY: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return function(spark, sf_dir)

        _REGISTRY[name] = in_utc
        return in_utc

    return register


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _times_as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(f"`{name}`").cast("string") for name in names})


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts without the time of their making."""
    flat = alerts.select("*", F.col("raw.*")).drop("raw", "alert_generated_at")
    return _times_as_text(flat, "@timestamp")


# Feeds to canonical events


@_query("normalize_objects")
def _objects(spark, sf_dir):
    raw = feeds.raw_aircraft(spark, sf_dir)
    return normalize_objects(raw, F.col("source"), F.col("ts"), keep=["event_id"])


@_query("normalize_states")
def _states(spark, sf_dir):
    return normalize_states(feeds.raw_states(spark, sf_dir), F.col("ts"), keep=["event_id"])


def _polled(spark, sf_dir, feed, **options):
    snapshots = parse_snapshots(feeds.envelopes(spark, sf_dir), feed)
    return normalize(snapshots, feed, F.col("ts"), keep=["event_id"], **options)


@_query("snapshot_objects")
def _snapshot_objects(spark, sf_dir):
    return _polled(spark, sf_dir, "adsbfi")


@_query("snapshot_states")
def _snapshot_states(spark, sf_dir):
    return _polled(spark, sf_dir, "opensky")


@_query("source_dispatch")
def _source_dispatch(spark, sf_dir):
    polls = [
        _polled(spark, sf_dir, feed).select(
            F.lit(feed).alias("configured"), "event_id", "source", "icao24", "callsign", "on_ground"
        )
        for feed in CONFIGURED_FEEDS
    ]
    return reduce(DataFrame.unionByName, polls)


@_query("ingest_counters")
def _ingest_counters(spark, sf_dir):
    counters = Observation("ingest")
    _run(_polled(spark, sf_dir, "adsbfi", counters=counters))
    return _one_row(spark, counters.get, "fetched", "sent")


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _one_row(spark, values: dict, *names: str) -> DataFrame:
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} long" for n in names))


# The monitored area


@_query("area_disc")
def _area_disc(spark, sf_dir):
    return within_disc(_located(spark, sf_dir), *DISC).select("event_id")


@_query("area_box")
def _area_box(spark, sf_dir):
    return within_box(_located(spark, sf_dir), *BOX).select("event_id")


def _located(spark, sf_dir):
    raw = feeds.raw_aircraft(spark, sf_dir)
    return raw.select("event_id", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"))


# Enrichment and routing


@_query("enrich_route")
def _enrich_route(spark, sf_dir):
    return feeds.routed(spark, sf_dir).withColumn("tags", F.array_join("tags", ","))


@_query("route_counts")
def _route_counts(spark, sf_dir):
    routes = feeds.routed(spark, sf_dir).groupBy("route").agg(F.count("*").alias("events"))
    return routes.select("route", topic_of(F.col("route"), Topics()).alias("topic"), "events")


@_query("route_marked")
def _route_marked(spark, sf_dir):
    """Events that bring a mark, fields of their transport, or a time that cannot be read."""
    arrived = feeds.marked_events(spark, sf_dir)
    routed = enrich_and_route(arrived)
    left = sum(name in routed.columns for name in TRANSPORT_FIELDS)
    return routed.select(
        "event_id", "route", topic_of(F.col("route"), Topics()).alias("topic"), "stream", "@timestamp", F.lit(left).cast("long").alias("transport_fields")
    )


@_query("telemetry_json_roundtrip")
def _json_roundtrip(spark, sf_dir):
    return _times_as_text(parse_telemetry(feeds.bus_records(spark, sf_dir)), "event_ts")


# Rule alerts


@_query("rule_alerts")
def _rule_alerts(spark, sf_dir):
    return _flat_alerts(rule_alerts(feeds.telemetry(spark, sf_dir)))


@_query("rule_alerts_by_type")
def _rule_alerts_by_type(spark, sf_dir):
    alerts = rule_alerts(feeds.telemetry(spark, sf_dir))
    return alerts.groupBy("alert_type", "severity").agg(F.count("*").alias("alerts"))


@_query("alert_payload")
def _alert_payload(spark, sf_dir):
    """What is on the bus for an alert: fields that are null are not there."""
    records = to_bus(rule_alerts(feeds.telemetry(spark, sf_dir)))
    value = F.col("value")
    return records.select(
        "key",
        F.get_json_object(value, "$.@timestamp").alias("@timestamp"),
        F.get_json_object(value, "$.alert_type").alias("alert_type"),
        F.get_json_object(value, "$.icao24").alias("icao24"),
        F.size(F.json_object_keys(value)).cast("long").alias("fields"),
        F.size(F.json_object_keys(F.get_json_object(value, "$.raw"))).cast("long").alias("raw_fields"),
    )


# Archive


def _archive(spark, sf_dir) -> str:
    path = scratch(spark, "archive")
    write_archive(to_archive(feeds.telemetry(spark, sf_dir)), path)
    return path


@_query("archive_roundtrip")
def _archive_roundtrip(spark, sf_dir):
    return _times_as_text(read_archive(spark, _archive(spark, sf_dir)), "event_ts", "event_date")


@_query("archive_one_day")
def _archive_one_day(spark, sf_dir):
    day = read_archive(spark, _archive(spark, sf_dir), ONE_DAY, ONE_DAY)
    return _times_as_text(day, "event_ts", "event_date")


@_query("archive_compacted")
def _archive_compacted(spark, sf_dir):
    """Days in several files of their own, then in another folder, twice, in few."""
    path, target = scratch(spark, "archive"), scratch(spark, "compacted")
    history = to_archive(feeds.telemetry(spark, sf_dir))
    for evening in (False, True):
        write_archive(history.filter((F.hour("event_ts") >= 12) == evening), path)
    for _ in range(2):
        compact_archive(spark, path, target)
    return _times_as_text(read_archive(spark, target), "event_ts", "event_date")


@_query("archive_open_and_closed")
def _archive_open_and_closed(spark, sf_dir):
    """A streamed archive of which some days were closed before the rest of their events came, some closed twice, and
    the closing of some was broken off; read as one history."""
    bus, path, target = FileBus(scratch(spark, "bus")), scratch(spark, "streamed"), scratch(spark, "closed")
    checkpoint = scratch(spark, "archive-checkpoint")
    records = feeds.numbered_records(spark, sf_dir)
    for third in range(3):
        bus.write(records.filter(F.col("event_id") % 3 == third).drop("event_id"))
        jobs.archive(spark, bus, path, checkpoint, trigger=jobs.ONCE).awaitTermination()
        # After the last third nothing is closed, so days have got files since.
        if third < 2:
            compact_archive(spark, path, target, date(2024, 1, 5 + third), date(2024, 1, 15))
    rewrite_days(spark, path, target, days_to_close(spark, path, target, date(2024, 1, 10), date(2024, 1, 20)))
    return _times_as_text(read_history(spark, path, target), "event_ts", "event_date")


# Features, labels, balance


def _features(spark, sf_dir):
    return model_features(feeds.telemetry(spark, sf_dir))


def _labelled(spark, sf_dir):
    return weak_labels(_features(spark, sf_dir))


@_query("training_features")
def _training_features(spark, sf_dir):
    return _features(spark, sf_dir).select("event_id", "source", *MODEL_VECTOR[:-1])


@_query("weak_labels")
def _weak_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("event_id", "label")


@_query("label_distribution")
def _label_distribution(spark, sf_dir):
    return label_distribution(_labelled(spark, sf_dir))


@_query("class_balance")
def _class_balance(spark, sf_dir):
    return class_balance(_labelled(spark, sf_dir))


@_query("class_weights")
def _class_weights(spark, sf_dir):
    labelled = _labelled(spark, sf_dir).select("event_id", "label")
    return with_weights(labelled, class_balance(labelled).first().w_pos)


@_query("source_index")
def _source_index(spark, sf_dir):
    features = _features(spark, sf_dir).select("source")
    indexed = source_indexer().fit(features).transform(features)
    return indexed.groupBy("source", "source_idx").agg(F.count("*").alias("events"))


@_query("feature_vectors")
def _feature_vectors(spark, sf_dir):
    features = _features(spark, sf_dir)
    indexed = source_indexer().fit(features.select("source")).transform(features)
    vector = vector_to_array("features")
    opened = [F.get(vector, F.lit(i)).alias(name) for i, name in enumerate(MODEL_VECTOR)]
    return vector_assembler().transform(indexed).select("event_id", *opened)


# Training and scoring


@_query("auc_fixed_scores")
def _auc_fixed_scores(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    scored = labelled.select("label", F.expr(feeds.LABELLED_SCORE_SQL).alias("score"))
    auc = area_under_roc(scored, "score")
    return spark.createDataFrame([(auc,)], "auc double").select(F.round("auc", 9).alias("auc"))


@_query("split_sizes")
def _split_sizes(spark, sf_dir):
    settings = Training()
    rows = split_history(feeds.telemetry(spark, sf_dir), settings, Thresholds(), scratch(spark, "split"))
    return rows.groupBy("side", "label").agg(F.count("*").alias("rows"))


def _trained(spark, sf_dir):
    history = to_archive(feeds.telemetry_once(spark, sf_dir))
    return train(history, scratch(spark, "training"))


@_query("train_metrics")
def _train_metrics(spark, sf_dir):
    """The balance, and whether the reported area is that of the trapezoids under the curve of the same predictions."""
    trained = _trained(spark, sf_dir)
    curve = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", numBins=0).evaluate(trained.predictions)
    auc = F.col("auc")
    exact = (F.abs(auc - curve) < 1e-9).alias("auc_exact")
    return trained.metrics.select(exact, auc.between(0, 1).alias("auc_in_range"), "n_pos", "n_neg", "n_classes", "w_pos")


@_query("train_and_score")
def _train_and_score(spark, sf_dir):
    """What must hold of every score, of the fitted model and of the one that was saved and loaded."""
    path = scratch(spark, "model")
    model = _trained(spark, sf_dir).model
    save_model(model, path)
    fitted = score(_features(spark, sf_dir), model)
    # Both models in one pass over the features.
    loaded = score(fitted.withColumnsRenamed({"prediction": "fitted", "p_anom": "p_fitted"}), PipelineModel.load(path))
    voted = F.when(F.col("p_fitted") > 0.5, 1.0).otherwise(0.0)
    return loaded.select(
        "event_id",
        F.col("p_fitted").between(0, 1).alias("in_range"),
        (F.col("fitted") == voted).alias("agrees"),
        ((F.col("p_anom") == F.col("p_fitted")) & (F.col("prediction") == F.col("fitted"))).alias("same_after_loading"),
    )


@_query("sample_predictions")
def _sample_predictions(spark, sf_dir):
    sample = sample_predictions(_trained(spark, sf_dir).predictions)
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    return sample.select(F.col("label").isin(0.0, 1.0).alias("labelled"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@_query("alerts_from_scores")
def _alerts_from_scores(spark, sf_dir):
    return _flat_alerts(model_alerts(feeds.fixed_scores(spark, sf_dir)))


# Publication


def _flat_documents(documents: DataFrame) -> DataFrame:
    flat = documents.select(
        "doc_id",
        "index",
        "@timestamp",
        "event_type",
        "detector",
        "alert_type",
        "reason",
        "severity",
        "icao24",
        "callsign",
        "source",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        "raw.*",
    )
    return _times_as_text(flat, "@timestamp")


@_query("alert_documents")
def _alert_documents(spark, sf_dir):
    return _flat_documents(alert_documents(feeds.alert_records(spark, sf_dir)))


@_query("publish_counters")
def _publish_counters(spark, sf_dir):
    counters = Observation("publish")
    _run(alert_documents(feeds.alert_records(spark, sf_dir), counters=counters))
    return _one_row(spark, counters.get, "indexed", "unreadable")


@_query("publish_replay")
def _publish_replay(spark, sf_dir):
    """The table after a batch and the same batch again."""
    path = scratch(spark, "index")
    ensure_index(spark, path)
    for batch_id in (0, 1):
        publish_batch(alert_documents(feeds.alert_records(spark, sf_dir)), batch_id, path)
    return _flat_documents(read_index(spark, path))


@_query("publish_corrected")
def _publish_corrected(spark, sf_dir):
    """The table after corrections, late versions and a replay of the first versions."""
    path = scratch(spark, "index")
    ensure_index(spark, path)
    for batch_id, records in enumerate(feeds.alert_versions(spark, sf_dir)):
        publish_batch(alert_documents(records), batch_id, path)
    return _flat_documents(read_index(spark, path))


@_query("documents_unmapped")
def _documents_unmapped(spark, sf_dir):
    """Fields of published documents that the table has no column for."""
    path = scratch(spark, "index")
    ensure_index(spark, path)
    publish_batch(alert_documents(feeds.observed_alert_records(spark, sf_dir)), 0, path)
    return read_index(spark, path).select(
        "doc_id",
        unmapped("$.observer.station.id", "bigint").alias("station"),
        unmapped("$.observer.station.name", "string").alias("station_name"),
        unmapped("$.observer.tags[1]", "string").alias("second_tag"),
        unmapped("$.observer.tags", "int").alias("of_another_kind"),
        unmapped("$.raw.squawk", "string").alias("squawk"),
    )


# Streams, run over all their input once


def _telemetry_bus(spark, sf_dir) -> FileBus:
    bus = FileBus(scratch(spark, "bus"))
    bus.write(feeds.bus_records(spark, sf_dir))
    return bus


def _stream(start, spark, *arguments, label: str, **options) -> None:
    query = start(spark, *arguments, checkpoint=scratch(spark, f"{label}-checkpoint"), trigger=jobs.ONCE, **options)
    query.awaitTermination()


def _landed(spark, sf_dir) -> str:
    path = scratch(spark, "landing")
    feeds.envelopes(spark, sf_dir).select("value").write.text(path)
    return path


@_query("stream_ingest")
def _stream_ingest(spark, sf_dir):
    out = FileBus(scratch(spark, "ingested"))
    _stream(jobs.ingest, spark, _landed(spark, sf_dir), "adsbfi", out, label="ingest")
    topics = Topics()
    value = F.col("value").cast("string")
    fields = ("icao24", "callsign", "location", "squawk", "stream", "dlq_reason")
    return out.read(spark, [topics.telemetry, topics.dead_letter, topics.raw]).select(
        "topic", *[F.get_json_object(value, f"$.{name}").alias(name) for name in fields]
    )


@_query("stream_ingest_broken")
def _stream_ingest_broken(spark, sf_dir):
    """Where the records of a landing folder go in which some lines are cut off."""
    path, out = scratch(spark, "landing"), FileBus(scratch(spark, "ingested"))
    value = F.col("value")
    cut = F.when(F.col("event_id") % feeds.CUT_OFF_EVERY == 0, F.substring(value, 1, 60)).otherwise(value)
    feeds.envelopes(spark, sf_dir).select(cut.alias("value")).write.text(path)
    _stream(jobs.ingest, spark, path, "adsbfi", out, label="ingest")
    topics = Topics()
    reason = F.get_json_object(value.cast("string"), "$.dlq_reason").alias("dlq_reason")
    records = out.read(spark, [topics.telemetry, topics.dead_letter, topics.raw]).select("topic", reason)
    return records.groupBy("topic", "dlq_reason").agg(F.count("*").alias("records"))


@_query("stream_ingest_polls")
def _stream_ingest_polls(spark, sf_dir):
    """The records of polls of no, one and many aircraft, some of which are cut off."""
    path, out = scratch(spark, "landing"), FileBus(scratch(spark, "ingested"))
    feeds.polls(spark, sf_dir).select("value").write.text(path)
    _stream(jobs.ingest, spark, path, "adsbfi", out, label="ingest")
    topics = Topics()
    value = F.col("value").cast("string")
    fields = [F.get_json_object(value, f"$.{name}").alias(name) for name in ("icao24", "callsign", "location", "squawk", "dlq_reason")]
    whole = F.get_json_object(value, "$.message").startswith('{"aircraft":[').alias("kept_whole")
    return out.read(spark, [topics.telemetry, topics.dead_letter, topics.raw]).select("topic", *fields, whole)


@_query("stream_ingest_area")
def _stream_ingest_area(spark, sf_dir):
    out = FileBus(scratch(spark, "ingested"))
    area = Area.from_env(SMALL_AREA)
    _stream(jobs.ingest, spark, _landed(spark, sf_dir), "adsbfi", out, label="ingest", area=area)
    value = F.col("value").cast("string")
    fields = ("icao24", "callsign", "location", "squawk")
    return out.read(spark, [Topics().telemetry]).select(*[F.get_json_object(value, f"$.{name}").alias(name) for name in fields])


def _chain(spark, sf_dir) -> tuple[FileBus, str]:
    """Landed files to the index by way of one folder bus that three jobs write to, published twice."""
    bus, path = FileBus(scratch(spark, "chain")), scratch(spark, "chain-index")
    _stream(jobs.ingest, spark, _landed(spark, sf_dir), "adsbfi", bus, label="ingest")
    _stream(jobs.alert_by_rules, spark, bus, bus, label="rules")
    _stream(jobs.alert_by_model, spark, bus, bus, _trained(spark, sf_dir).model, label="model")
    for _ in range(2):
        _stream(jobs.publish, spark, bus, path, label="publish")
    return bus, path


@_query("stream_chain_to_index")
def _stream_chain_to_index(spark, sf_dir):
    _, path = _chain(spark, sf_dir)
    rules = read_index(spark, path).filter(F.col("detector") == "spark_rules")
    return rules.select("index", "alert_type", "severity", "icao24", "callsign", "lat", "lon")


@_query("stream_chain_complete")
def _stream_chain_complete(spark, sf_dir):
    """Whether ids are distinct and every alert on the bus, of either job, is in the index."""
    bus, path = _chain(spark, sf_dir)
    index = read_index(spark, path)
    topics = Topics()
    sent = bus.read(spark, [topics.rule_alerts, topics.model_alerts])
    counts = index.agg(F.count("*").alias("documents"), F.count_distinct("doc_id").alias("ids")).first()
    missing = sent.select(F.concat_ws("-", "topic", "record_id").alias("doc_id")).join(index, "doc_id", "left_anti").count()
    by_model = int(index.filter(F.col("detector") == "spark_ml").isEmpty())
    return _one_row(spark, {"repeated": counts.documents - counts.ids, "missing": missing, "no_model_alert": by_model}, "repeated", "missing", "no_model_alert")


@_query("stream_route_index")
def _stream_route_index(spark, sf_dir):
    path = scratch(spark, "routes")
    _stream(jobs.index_routes, spark, _landed(spark, sf_dir), "adsbfi", path, label="routes", prefix="flights")
    return spark.read.parquet(path).groupBy("index").agg(F.count("*").alias("events"))


@_query("stream_rule_alerts")
def _stream_rule_alerts(spark, sf_dir):
    out = FileBus(scratch(spark, "alerts"))
    _stream(jobs.alert_by_rules, spark, _telemetry_bus(spark, sf_dir), out, label="rules")
    return _alerts_on(spark, out, Topics().rule_alerts).drop("p_anom")


def _spoilt_bus(spark, sf_dir) -> FileBus:
    bus = FileBus(scratch(spark, "bus"))
    bus.write(feeds.spoilt_records(spark, sf_dir).drop("event_id"))
    return bus


def _letters_on(spark, bus: FileBus) -> DataFrame:
    value = F.col("value").cast("string")
    return bus.read(spark, [Topics().dead_letter]).select(
        *[F.get_json_object(value, f"$.{name}").alias(name) for name in ("message", "dlq_reason", "detector")]
    )


@_query("stream_rules_broken")
def _stream_rules_broken(spark, sf_dir):
    """Alerts by type and dead letters by their text, of records of which some cannot be read."""
    out, topics = FileBus(scratch(spark, "alerts")), Topics()
    _stream(jobs.alert_by_rules, spark, _spoilt_bus(spark, sf_dir), out, label="rules")
    letters = _letters_on(spark, out).withColumn("message", F.substring("message", 1, 12))
    alerts = _alerts_on(spark, out, topics.rule_alerts).select("alert_type", "detector")
    rows = alerts.withColumn("topic", F.lit(topics.rule_alerts)).unionByName(
        letters.withColumn("topic", F.lit(topics.dead_letter)), allowMissingColumns=True
    )
    return rows.groupBy("topic", "alert_type", "detector", "message", "dlq_reason").agg(F.count("*").alias("records"))


@_query("stream_model_broken")
def _stream_model_broken(spark, sf_dir):
    """The dead letters of the scoring job, and whether its alerts are those of the readable records."""
    out, bus, model = FileBus(scratch(spark, "alerts")), _spoilt_bus(spark, sf_dir), _trained(spark, sf_dir).model
    _stream(jobs.alert_by_model, spark, bus, out, model, label="model")
    telemetry = parse_telemetry(bus.read(spark, [Topics().telemetry]))
    expected = model_alerts(score(model_features(telemetry), model)).count()
    sent = out.read(spark, [Topics().model_alerts]).count()
    return _letters_on(spark, out).withColumn("alerts_agree", F.lit(sent == expected and sent > 0))


def _alerts_on(spark, bus: FileBus, topic: str) -> DataFrame:
    return _flat_alerts(parse_alerts(bus.read(spark, [topic])).drop("readable"))


@_query("stream_archive")
def _stream_archive(spark, sf_dir):
    path = scratch(spark, "streamed")
    _stream(jobs.archive, spark, _telemetry_bus(spark, sf_dir), path, label="archive")
    return _times_as_text(read_archive(spark, path), "event_ts", "event_date")


@_query("stream_side_by_side")
def _stream_side_by_side(spark, sf_dir):
    """What three jobs that run at the same time make of one bus; of the scored alerts, whether they are all there."""
    bus, path, model = _telemetry_bus(spark, sf_dir), scratch(spark, "streamed"), _trained(spark, sf_dir).model
    by_rules, by_model = FileBus(scratch(spark, "alerts")), FileBus(scratch(spark, "model-alerts"))
    checkpoint = {name: scratch(spark, f"{name}-checkpoint") for name in ("rules", "archive", "score")}
    starts = {
        "rules": lambda: jobs.alert_by_rules(spark, bus, by_rules, checkpoint["rules"], trigger=jobs.ONCE),
        "archive": lambda: jobs.archive(spark, bus, path, checkpoint["archive"], trigger=jobs.ONCE),
        "score": lambda: jobs.alert_by_model(spark, bus, by_model, model, checkpoint["score"], trigger=jobs.ONCE),
    }
    fallen = Together(spark, starts).start().wait()
    if fallen:
        raise RuntimeError(f"jobs have fallen: {fallen}")
    topics = Topics()
    telemetry = parse_telemetry(bus.read(spark, [topics.telemetry]))
    expected = model_alerts(score(model_features(telemetry), model)).count()
    sent = by_model.read(spark, [topics.model_alerts]).count()
    rules = _alerts_on(spark, by_rules, topics.rule_alerts).select(F.lit("rules").alias("job"), "icao24", "alert_type")
    kept = read_archive(spark, path).select(F.lit("archive").alias("job"), "icao24", F.lit(None).cast("string").alias("alert_type"))
    both = rules.unionByName(kept).groupBy("job", "icao24", "alert_type").agg(F.count("*").alias("records"))
    return both.withColumn("scored_agree", F.lit(sent == expected and sent > 0))


@_query("stream_start_position")
def _stream_start_position(spark, sf_dir):
    """The alerts of a job that began at the latest record, when half of them were there, and of one that began at the
    earliest, each started twice."""
    folder, records = scratch(spark, "bus"), feeds.numbered_records(spark, sf_dir)
    outs = {place: FileBus(scratch(spark, f"alerts-{place}")) for place in ("latest", "earliest")}
    checkpoint = {place: scratch(spark, f"rules-{place}") for place in outs}
    for half in range(2):
        FileBus(folder).write(records.filter(F.col("event_id") % 2 == half).drop("event_id"))
        for place, out in outs.items():
            bus = FileBus(folder, starting_offsets=place)
            jobs.alert_by_rules(spark, bus, out, checkpoint[place], trigger=jobs.ONCE).awaitTermination()
    alerts = [
        _alerts_on(spark, out, Topics().rule_alerts).drop("p_anom").withColumn("began_at", F.lit(place))
        for place, out in outs.items()
    ]
    return reduce(DataFrame.unionByName, alerts)


@_query("publish_counts_kept")
def _publish_counts_kept(spark, sf_dir):
    """The counts of a publishing job after several batches, a stop, a restart, and a batch that was repeated since the
    job had ended before it could note that batch as done."""
    bus = FileBus(scratch(spark, "alert-bus"), max_files=1)
    path, checkpoint, kept = scratch(spark, "published"), scratch(spark, "publish-checkpoint"), scratch(spark, "counters")
    records = feeds.alert_records(spark, sf_dir)
    for half in range(2):
        bus.write(records.filter(F.col("offset") % 2 == half))
        _counted_publication(spark, bus, path, checkpoint, kept)
    remove_path(spark, f"{checkpoint}/commits/{max(int(n) for n in names_below(spark, f'{checkpoint}/commits') if n.isdigit())}")
    _counted_publication(spark, bus, path, checkpoint, kept)
    return CounterTable(spark, kept).frame([jobs.PUBLISH_COUNTERS])


def _counted_publication(spark, bus, path, checkpoint, kept):
    counts = RunningCounts(jobs.PUBLISH_COUNTERS, table=CounterTable(spark, kept))
    spark.streams.addListener(counts)
    try:
        query = jobs.publish(spark, bus, path, checkpoint, trigger=jobs.ONCE)
        query.awaitTermination()
        counts.wait_for(query)
    finally:
        spark.streams.removeListener(counts)


@_query("stream_scored")
def _stream_scored(spark, sf_dir):
    out = FileBus(scratch(spark, "model-alerts"))
    model = _trained(spark, sf_dir).model
    bus = _telemetry_bus(spark, sf_dir)
    _stream(jobs.alert_by_model, spark, bus, out, model, label="model")
    streamed = _alerts_on(spark, out, Topics().model_alerts).drop("geo_altitude_ft", "on_ground")
    telemetry = parse_telemetry(bus.read(spark, [Topics().telemetry]))
    batch = _flat_alerts(model_alerts(score(model_features(telemetry), model))).select(*streamed.columns)
    return _one_row(
        spark,
        {"only_streamed": streamed.exceptAll(batch).count(), "only_batch": batch.exceptAll(streamed).count(), "silent": int(batch.isEmpty())},
        "only_streamed",
        "only_batch",
        "silent",
    )


@_query("stream_publish")
def _stream_publish(spark, sf_dir):
    """The table after the stream ran twice, the second time without memory of the first."""
    bus = FileBus(scratch(spark, "alert-bus"))
    bus.write(feeds.alert_records(spark, sf_dir))
    path = scratch(spark, "published")
    for _ in range(2):
        _stream(jobs.publish, spark, bus, path, label="publish")
    return _flat_documents(read_index(spark, path))
