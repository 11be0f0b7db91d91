"""Aircraft feeds derived row by row from the ``events`` table.

The expressions are plain SQL that gives the same values in Spark and in
DuckDB, so a query and its oracle start from the same raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Topics
from ..functions.once import expand_once
from ..operators.bus_records import as_json
from ..operators.features import model_features
from ..operators.normalize import normalize_objects
from ..operators.routing import enrich_and_route, to_routed_bus, topic_of
from ..operators.rules import rule_alerts
from ..operators.scoring import model_alerts
from ..operators.telemetry import with_event_ts
from ..schemas import RAW_AIRCRAFT

AIRCRAFT_SQL = {
    "hex": """CASE WHEN event_id % 41 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 43 = 0 THEN '  '
      ELSE ' AB' || lpad(CAST(user_id AS STRING), 4, '0') || ' ' END""",
    "flight": """CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 7 = 0 THEN '   '
      ELSE 'TST' || CAST(user_id AS STRING) || '  ' END""",
    "lat": """CASE WHEN event_id % 23 = 0 THEN CAST(NULL AS STRING)
      WHEN event_id % 71 = 7 THEN CAST(CAST(4540 + event_id % 15 AS DOUBLE) / 100 AS STRING)
      ELSE CAST(CAST(4140 + (event_id * 37) % 100 AS DOUBLE) / 100 AS STRING) END""",
    "lon": """CASE WHEN event_id % 29 = 0 THEN ''
      WHEN event_id % 71 = 7 THEN CAST(CAST(910 + event_id % 20 AS DOUBLE) / 100 AS STRING)
      ELSE CAST(CAST(1200 + (event_id * 53) % 100 AS DOUBLE) / 100 AS STRING) END""",
    "alt_baro": """CASE WHEN event_id % 13 = 0 THEN 'ground' WHEN event_id % 31 = 0 THEN CAST(NULL AS STRING)
      WHEN event_id % 59 = 4 THEN CAST(65000 + event_id % 1000 AS STRING)
      ELSE CAST(30000 + (event_id * 17) % 8000 AS STRING) END""",
    "alt_geom": "CAST(30200 + (event_id * 17) % 8000 AS STRING)",
    "gs": """CASE WHEN event_id % 37 = 0 THEN 'n/a'
      WHEN event_id % 61 = 5 THEN CAST(750 + event_id % 150 AS STRING)
      ELSE CAST(400 + (event_id * 3) % 80 AS STRING) END""",
    "track": "CAST((event_id * 7) % 360 AS STRING)",
    "baro_rate": """CASE WHEN event_id % 47 = 0 THEN CAST(NULL AS STRING)
      WHEN event_id % 67 = 6 THEN CAST(-11000 - event_id % 4000 AS STRING)
      ELSE CAST((event_id * 11) % 1000 - 500 AS STRING) END""",
    "squawk": """CASE WHEN event_id % 53 = 1 THEN '7500' WHEN event_id % 53 = 2 THEN '7600'
      WHEN event_id % 53 = 3 THEN ' 7700' WHEN event_id % 9 = 0 THEN CAST(NULL AS STRING)
      ELSE '1000' END""",
    "category": """CASE event_type WHEN 'click' THEN 'A1' WHEN 'view' THEN 'A3' WHEN 'purchase' THEN 'A5'
      ELSE CAST(NULL AS STRING) END""",
}

SOURCE_SQL = "CASE WHEN user_id % 3 = 0 THEN 'airplaneslive' ELSE 'adsbfi' END"

# By position in the state vector.
STATE_SQL = {
    0: """CASE WHEN event_id % 41 = 0 THEN CAST(NULL AS STRING)
      ELSE 'CD' || lpad(CAST(user_id AS STRING), 4, '0') END""",
    1: """CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 7 = 0 THEN '   '
      ELSE 'OSK' || CAST(user_id AS STRING) || ' ' END""",
    5: "CAST(CAST(1200 + (event_id * 53) % 100 AS DOUBLE) / 100 AS STRING)",
    6: """CASE WHEN event_id % 23 = 0 THEN CAST(NULL AS STRING)
      ELSE CAST(CAST(4140 + (event_id * 37) % 100 AS DOUBLE) / 100 AS STRING) END""",
    7: """CASE WHEN event_id % 31 = 0 THEN CAST(NULL AS STRING)
      WHEN event_id % 59 = 4 THEN CAST(20000 + event_id % 300 AS STRING)
      ELSE CAST(9144 + (event_id * 17) % 2400 AS STRING) END""",
    8: "CASE WHEN event_id % 13 = 0 THEN 'true' ELSE 'false' END",
    9: "CAST(200 + (event_id * 3) % 40 AS STRING)",
    10: "CAST((event_id * 7) % 360 AS STRING)",
    11: "CAST((event_id * 11) % 10 - 5 AS STRING)",
    13: "CAST(9200 + (event_id * 17) % 2400 AS STRING)",
    14: "CASE WHEN event_id % 53 = 1 THEN '7500' ELSE CAST(NULL AS STRING) END",
}
STATE_LENGTH = 17

# Positions whose JSON value is text, not a number or a flag.
STATE_TEXT = (0, 1, 14)

ALERT_PARTITIONS = 3


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def raw_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft objects, each made once, as if they were read from a file."""
    fields = ", ".join(f"{sql} AS {name}" for name, sql in (AIRCRAFT_SQL | {"source": SOURCE_SQL}).items())
    return expand_once(_events(spark, sf_dir), F.expr(f"struct({fields})"), keep=["event_id", "ts"])


def raw_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = [F.expr(STATE_SQL[i]) if i in STATE_SQL else F.lit(None).cast("string") for i in range(STATE_LENGTH)]
    return expand_once(_events(spark, sf_dir), F.struct(F.array(*vector).alias("state")), keep=["event_id", "ts"])


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON envelopes as polled, one per event: ``event_id, ts, value``.

    List ``aircraft`` holds the event's object, ``ac`` the same object under an
    identifier with another letter, ``states`` its vector. By the remainder of
    ``event_id`` and 4: 1 has an empty and 2 no ``aircraft``, 3 has an empty
    ``ac``, 2 has null ``states``.
    """
    own = F.struct(*[F.expr(AIRCRAFT_SQL[name]).alias(name) for name in RAW_AIRCRAFT.names])
    other = own.withField("hex", F.replace(F.expr(AIRCRAFT_SQL["hex"]), F.lit("AB"), F.lit("XY")))
    kind = F.col("event_id") % 4

    def member(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    aircraft = F.when(kind == 1, "[]").otherwise(F.to_json(F.array(own)))
    ac = F.when(kind == 3, "[]").otherwise(F.to_json(F.array(other)))
    states = F.when(kind == 2, "null").otherwise(F.concat(F.lit("["), _vector_json(), F.lit("]")))
    members = F.concat_ws(
        ",", F.when(kind != 2, member("aircraft", aircraft)), member("ac", ac), member("states", states)
    )
    return _events(spark, sf_dir).select("event_id", "ts", F.concat(F.lit("{"), members, F.lit("}")).alias("value"))


def _vector_json() -> Column:
    def scalar(i: int) -> Column:
        if i not in STATE_SQL:
            return F.lit("null")
        value = F.expr(STATE_SQL[i])
        if i in STATE_TEXT:
            value = F.concat(F.lit('"'), value, F.lit('"'))
        return F.coalesce(value, F.lit("null"))

    return F.concat(F.lit("["), F.concat_ws(",", *[scalar(i) for i in range(STATE_LENGTH)]), F.lit("]"))


# Polls of several aircraft: so many events in a row are looked at by one, of which it answers with none to all. Of
# every so many polls one is cut off at its end.
POLL_OF, CUT_POLL_EVERY = 50, 13
POLLED_SQL = f"event_id % {POLL_OF} < CAST(floor(event_id / {POLL_OF}) AS BIGINT) * 7 % {POLL_OF + 1}"


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of 0 to 50 aircraft: ``poll, value``."""
    events = _events(spark, sf_dir).withColumn("poll", F.expr(f"event_id div {POLL_OF}"))
    craft = F.struct(*[F.expr(AIRCRAFT_SQL[name]).alias(name) for name in RAW_AIRCRAFT.names])
    answers = events.groupBy("poll").agg(F.collect_list(F.when(F.expr(POLLED_SQL), craft)).alias("aircraft"))
    value = F.to_json(F.struct("aircraft"))
    cut = F.when(F.col("poll") % CUT_POLL_EVERY == 5, F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    return answers.select("poll", cut.alias("value"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed events with their ``event_id``; they arrived when they happened."""
    events = normalize_objects(
        raw_aircraft(spark, sf_dir), F.col("source"), F.col("ts"), keep=["event_id", "ts"]
    )
    return enrich_and_route(events.withColumnRenamed("ts", "@timestamp"))


# Of every five events the first brings a mark of its own and the second the
# usual one; of every seventeen the first has a time that cannot be read.
MARK_SQL = "CASE event_id % 5 WHEN 0 THEN 'other' WHEN 1 THEN 'telemetry' END"


def marked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = normalize_objects(raw_aircraft(spark, sf_dir), F.col("source"), F.col("ts"), keep=["event_id", "ts"])
    soon = F.when(F.col("event_id") % 17 == 0, "soon").otherwise(F.col("event_time"))
    return events.withColumnRenamed("ts", "@timestamp").withColumns(
        {"stream": F.expr(MARK_SQL), "event_time": soon, "host": F.lit("gateway"), "http": F.lit("1.1")}
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_ts(routed(spark, sf_dir).filter(F.col("route") == "telemetry"))


def telemetry_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for those who test most columns: each is made once, as if it was read from a file."""
    events = telemetry(spark, sf_dir)
    return expand_once(events, F.struct(*[F.col(f"`{name}`") for name in events.columns]))


# Of every so many records on the telemetry topic one each is cut off, a list, a number, empty, and of another stream.
SPOILT_EVERY = 89


def spoilt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the telemetry topic, some of which cannot be read: ``event_id`` and the columns of the bus."""
    events = routed(spark, sf_dir).filter(F.col("route") == "telemetry")
    key, value = as_json([name for name in events.columns if name not in ("event_id", "route")])
    kind = F.col("event_id") % SPOILT_EVERY
    text = (
        F.when(kind == 0, F.substring(value, 1, 60))
        .when(kind == 1, "[]")
        .when(kind == 2, "5")
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, '{"stream":"other"}')
        .otherwise(value)
    )
    return events.select("event_id", key, text.alias("value"), F.lit(Topics().telemetry).alias("topic"))


def numbered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the bus with the ``event_id`` of each, which is not in them."""
    events = routed(spark, sf_dir)
    key, value = as_json([name for name in events.columns if name not in ("event_id", "route")])
    return events.select("event_id", key, value, topic_of(F.col("route"), Topics()).alias("topic"))


def bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_routed_bus(routed(spark, sf_dir).drop("event_id"))


# A score that depends on the event alone stands in for the model, whose own
# depends on how the data is laid out.
FIXED_SCORE_SQL = "CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000"

# The same with ties between the classes and a lead for the positive one.
LABELLED_SCORE_SQL = "(CAST((event_id * 7919) % 700 AS DOUBLE) + 300 * label) / 1000"


def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = model_features(telemetry_once(spark, sf_dir))
    scored = features.withColumn("p_anom", F.expr(FIXED_SCORE_SQL))
    return scored.withColumn("prediction", F.when(F.col("p_anom") >= 0.5, 1.0).otherwise(0.0))


# Every so many alerts one is cut off in the middle of its text.
CUT_OFF_EVERY = 97


def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both detectors' alerts on the bus, a few of them unreadable."""
    topics = Topics()
    by_rules = rule_alerts(telemetry(spark, sf_dir), keep=["event_id"])
    by_model = model_alerts(fixed_scores(spark, sf_dir), keep=["event_id"])
    return _alerts_on(by_rules, topics.rule_alerts).unionByName(_alerts_on(by_model, topics.model_alerts))


def _alerts_on(alerts: DataFrame, topic: str) -> DataFrame:
    key, value = as_json([name for name in alerts.columns if name != "event_id"])
    text = F.when(F.col("event_id") % CUT_OFF_EVERY == 0, F.substring(value, 1, 60)).otherwise(value)
    return alerts.select(
        key,
        text.alias("value"),
        F.lit(topic).alias("topic"),
        F.expr(f"CAST(event_id % {ALERT_PARTITIONS} AS INT)").alias("partition"),
        F.expr(f"event_id div {ALERT_PARTITIONS}").alias("offset"),
    )


STATIONS = 7


def observed_alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule alerts on the bus with a nested field that the contract does not know."""
    alerts = rule_alerts(telemetry(spark, sf_dir), keep=["event_id"])
    station = F.struct((F.col("event_id") % STATIONS).alias("id"), F.when(F.col("event_id") % 2 == 0, "north").alias("name"))
    tags = F.array(F.lit("first"), F.concat(F.lit("tag"), F.col("event_id") % 3))
    return _alerts_on(alerts.withColumn("observer", F.struct(station.alias("station"), tags.alias("tags"))), Topics().rule_alerts)


# Of every so many alerts one is sent again with other values: as a correction, as one without a time, as one that
# comes late.
CORRECTED_EVERY, UNDATED_EVERY, LATE_EVERY = 3, 4, 5


def alert_versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of alerts at the same places on the bus: first ones, other versions of some, the first ones again.

    Rule alerts have times on the bus, model alerts have none, so of these the later batch is the newer.
    """
    topics = Topics()
    dated = rule_alerts(telemetry(spark, sf_dir), keep=["event_id"])
    plain = model_alerts(fixed_scores(spark, sf_dir), keep=["event_id"])

    def sent(alerts: DataFrame, topic: str, every: int | None, reason: str | None, time: str | None) -> DataFrame:
        if every is not None:
            changed = {"reason": F.lit(reason), "severity": F.lit(1)}
            alerts = alerts.filter(F.col("event_id") % every == 0).withColumns(changed)
        return _alerts_on(alerts, topic).withColumn("timestamp", F.lit(time).cast("timestamp"))

    first = sent(dated, topics.rule_alerts, None, None, "2024-03-02").unionByName(sent(plain, topics.model_alerts, None, None, None))
    corrections = sent(dated, topics.rule_alerts, CORRECTED_EVERY, "corrected", "2024-03-03")
    late = sent(dated, topics.rule_alerts, LATE_EVERY, "late", "2024-03-01")
    undated = sent(plain, topics.model_alerts, UNDATED_EVERY, "corrected", None)
    again = sent(dated, topics.rule_alerts, None, None, "2024-03-02")
    return [first, corrections.unionByName(late).unionByName(undated), again]
