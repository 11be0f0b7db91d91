"""Run one job: ``spark-submit run.py <job>``, configured by the environment.

    ingest   landed snapshots to routed bus topics    LANDING_PATH, SOURCE,
             or those of one area                     AREA_LAT, AREA_LON, AREA_DIST_NM
    index    the same events to the search table      LANDING_PATH, SOURCE, INDEX_PATH
    compact  closed days of the archive, rewritten    PARQUET_PATH, COMPACT_PATH,
             into fewer files of another folder       FIRST_DAY, LAST_DAY
    rules    telemetry to rule alerts                 TOPIC_IN, TOPIC_OUT
    archive  telemetry to Parquet by date             TOPIC_IN, PARQUET_PATH
    train    archive to model                         PARQUET_PATH, MODEL_OUT,
             or some days of it                       FIRST_DAY, LAST_DAY
    score    telemetry to model alerts                TOPIC_IN, TOPIC_OUT, MODEL_PATH
    publish  alerts to the document table             TOPICS, INDEX_PATH
    together several of these streams in one session  JOBS, RESTARTS
             and what each of them reads

All that touch the bus read KAFKA_BOOTSTRAP, or BUS_PATH and BUS_OUT_PATH for
folders of bus records; streams read CHECKPOINT_DIR and STARTING_OFFSETS, and
KAFKA_MIN_PARTITIONS, KAFKA_MAX_OFFSETS, LANDING_MAX_FILES and TRIGGER_INTERVAL
to size their batches. COUNTERS_PATH keeps their counters from run to run. Writers to Kafka read KAFKA_ACKS and KAFKA_COMPRESSION.
"""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Mapping
from dataclasses import replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .config import Area, Geofence, Index, Scoring, Thresholds, Topics, Training
from .operators.learning import OneClassError, fit, label_counts, prepare, sample_predictions, save_model
from .session import forget, open_session, scratch, shared_folder
from .sources.archive import compact_archive, read_archive, read_history
from .sources.bus import Bus, FileBus, KafkaBus
from .streaming import jobs
from .streaming.counters import CounterTable, RunningCounts
from .streaming.together import Together

# Where the data lies unless the environment says otherwise.
ARCHIVE_PATH = "/data/telemetry_parquet/flights"
MODEL_PATH = "/data/models/flight_anomaly_clf"
BROKERS = "kafka:29092"
COUNTERS = {"ingest": jobs.INGEST_COUNTERS, "publish": jobs.PUBLISH_COUNTERS}


def _bus(env: Mapping[str, str], folder: str, offsets: str) -> Bus:
    if folder in env:
        # A folder is read from its beginning, unless it is asked for otherwise.
        return FileBus(env[folder], starting_offsets=env.get("STARTING_OFFSETS", "earliest"))
    limits = {name: int(env[name]) for name in ("KAFKA_MIN_PARTITIONS", "KAFKA_MAX_OFFSETS") if name in env}
    return KafkaBus(
        env.get("KAFKA_BOOTSTRAP", BROKERS),
        env.get("STARTING_OFFSETS", offsets),
        limits.get("KAFKA_MIN_PARTITIONS"),
        limits.get("KAFKA_MAX_OFFSETS"),
        env.get("KAFKA_ACKS"),
        env.get("KAFKA_COMPRESSION"),
    )


def run(job: str, spark: SparkSession, env: Mapping[str, str], trigger: Mapping | None = None) -> None:
    """Run a job to its end, or until it is stopped."""
    if job == "train":
        settings = Training.from_env(env), Thresholds.from_env(env)
        _train(_history(spark, env), env.get("MODEL_OUT", MODEL_PATH), *settings)
    elif job == "compact":
        compact_archive(spark, env.get("PARQUET_PATH", ARCHIVE_PATH), env["COMPACT_PATH"], *_days(env))
    elif job == "together":
        _together(spark, env, trigger)
    else:
        _start(job, spark, env, trigger).awaitTermination()


def _days(env: Mapping[str, str]) -> list[date | None]:
    return [date.fromisoformat(env[name]) if name in env else None for name in ("FIRST_DAY", "LAST_DAY")]


def _history(spark: SparkSession, env: Mapping[str, str]) -> DataFrame:
    path = env.get("PARQUET_PATH", ARCHIVE_PATH)
    if "COMPACT_PATH" in env:
        return read_history(spark, path, env["COMPACT_PATH"], *_days(env))
    return read_archive(spark, path, *_days(env))


def _together(spark: SparkSession, env: Mapping[str, str], trigger: Mapping | None) -> None:
    """The jobs named in JOBS, each with a checkpoint of its own; if any has fallen in the end, so has this one."""
    names = [name.strip() for name in env["JOBS"].split(",")]
    root = env.get("CHECKPOINT_DIR") or f"{shared_folder(spark)}/skyledger"

    def starter(name: str):
        return lambda: _start(name, spark, {**env, "CHECKPOINT_DIR": f"{root}/{name}"}, trigger)

    fallen = Together(spark, {name: starter(name) for name in names}, int(env.get("RESTARTS", "0"))).start().wait()
    if any(len(falls) > int(env.get("RESTARTS", "0")) for falls in fallen.values()):
        raise SystemExit(1)


def _start(job: str, spark: SparkSession, env: Mapping[str, str], trigger: Mapping | None = None) -> StreamingQuery:
    """Start a streaming job."""
    checkpoint = env.get("CHECKPOINT_DIR") or f"{shared_folder(spark)}/skyledger/{job}"
    # The archive wants everything, the detectors what happens now.
    bus = _bus(env, "BUS_PATH", "earliest" if job == "archive" else "latest")
    out = _bus(env, "BUS_OUT_PATH", "latest")
    topics = Topics()
    if "TOPIC_IN" in env:
        topics = replace(topics, telemetry=env["TOPIC_IN"])
    if "TOPIC_OUT" in env:
        topics = replace(topics, rule_alerts=env["TOPIC_OUT"], model_alerts=env["TOPIC_OUT"])
    source = env.get("SOURCE", "adsbfi")
    index = Index.from_env(env)
    # The feed is asked for one area; without any of these settings, for what has landed.
    area = Area.from_env(env) if any(name.startswith("AREA_") for name in env) else None
    archive_path = env.get("PARQUET_PATH", ARCHIVE_PATH)
    bounds = Thresholds.from_env(env)
    landing = int(env["LANDING_MAX_FILES"]) if "LANDING_MAX_FILES" in env else None
    if trigger is None and "TRIGGER_INTERVAL" in env:
        trigger = jobs.every(env["TRIGGER_INTERVAL"])

    table = CounterTable(spark, env["COUNTERS_PATH"]) if "COUNTERS_PATH" in env else None
    if job in COUNTERS:
        spark.streams.addListener(RunningCounts(COUNTERS[job], table=table))
    unreadable = {"ingest": jobs.LANDING_COUNTERS, "rules": jobs.RULE_COUNTERS, "score": jobs.MODEL_COUNTERS}
    if job in unreadable:
        spark.streams.addListener(RunningCounts(unreadable[job], every=1, table=table))
    if job == "ingest":
        query = jobs.ingest(spark, env["LANDING_PATH"], source, out, checkpoint, topics, landing, trigger, area)
    elif job == "index":
        query = jobs.index_routes(
            spark, env["LANDING_PATH"], source, env["INDEX_PATH"], checkpoint, index.prefix, landing, trigger, area
        )
    elif job == "rules":
        query = jobs.alert_by_rules(spark, bus, out, checkpoint, topics, bounds, Geofence.from_env(env), trigger)
    elif job == "archive":
        query = jobs.archive(spark, bus, archive_path, checkpoint, topics, trigger)
    elif job == "score":
        model = PipelineModel.load(env.get("MODEL_PATH", MODEL_PATH))
        query = jobs.alert_by_model(spark, bus, out, model, checkpoint, topics, Scoring.from_env(env), trigger)
    elif job == "publish":
        query = jobs.publish(spark, bus, env["INDEX_PATH"], checkpoint, index, trigger)
    else:
        raise SystemExit(__doc__)
    return query


def _train(history: DataFrame, model_path: str, settings: Training, bounds: Thresholds) -> None:
    spark = history.sparkSession
    table = scratch(spark, "training")
    try:
        prepared = prepare(history, table, settings, bounds)
        label_counts(prepared).show()
        trained = fit(prepared, settings)
        trained.metrics.show()
        sample_predictions(trained.predictions).show(truncate=False)
        save_model(trained.model, model_path)
    except OneClassError as problem:
        print(problem, file=sys.stderr)
        raise SystemExit(2) from problem
    finally:
        forget(spark, table)


def main(arguments: list[str] | None = None) -> None:
    arguments = sys.argv[1:] if arguments is None else arguments
    if len(arguments) != 1:
        raise SystemExit(__doc__)
    logging.basicConfig(level=logging.INFO)
    run(arguments[0], open_session(f"skyledger-{arguments[0]}", fair=arguments[0] == "together"), os.environ)


if __name__ == "__main__":
    main()
