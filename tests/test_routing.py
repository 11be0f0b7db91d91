import json

from pyspark.sql import functions as F

from skyledger.operators.routing import enrich_and_route, to_route_index, to_routed_bus

SCHEMA = "event_time string, lat double, lon double, stream string, host string, `@timestamp` timestamp"


def routed(spark, *rows):
    df = spark.createDataFrame([(*r, "gateway", None) for r in rows], SCHEMA)
    return enrich_and_route(df.withColumn("@timestamp", F.lit("2024-01-15 10:00:05.25").cast("timestamp")))


def test_located_event(spark):
    row = routed(spark, ("2024-01-15T10:00:00Z", 41.9, 12.5, None)).first()
    assert row["@timestamp"] == "2024-01-15T10:00:00.000Z" and row.ingest_ts == "2024-01-15T10:00:05.250Z"
    assert (row.event_type, row.stream, row.location, row.route) == ("flight_telemetry", "telemetry", "41.9,12.5", "telemetry")
    assert row.tags is None and row.dlq_reason is None and "host" not in row.asDict()


def test_zero_is_a_position_and_null_is_not(spark):
    zero, no_lat, no_lon = routed(spark, (None, 0.0, 0.0, None), (None, None, 1.0, None), (None, 1.0, None, None)).collect()
    assert zero.route == "telemetry" and zero.location == "0.0,0.0"
    for row in (no_lat, no_lon):
        assert (row.route, row.dlq_reason, row.tags, row.stream) == ("dlq", "missing_position", ["missing_position"], None)
        assert row.location is None


def test_own_stream_mark(spark):
    rows = routed(spark, (None, 1.0, 1.0, "other"), (None, 1.0, 1.0, "telemetry"), (None, None, 1.0, "other"), (None, None, 1.0, "telemetry"))
    assert [r.route for r in rows.collect()] == ["raw", "raw", "dlq", "telemetry"]


def test_arrival_stands_in_for_an_unreadable_time(spark):
    for time in ("yesterday", None):
        assert routed(spark, (time, 1.0, 1.0, None)).first()["@timestamp"] == "2024-01-15T10:00:05.250Z"


def test_records_name_their_topic_and_leave_out_nulls(spark):
    df = routed(spark, (None, 1.0, 2.0, None), (None, None, 1.0, None), (None, 1.0, 1.0, "x"))
    telemetry, rejected, rest = to_routed_bus(df).collect()
    assert [telemetry.topic, rejected.topic, rest.topic] == ["flights.telemetry", "flights.dlq", "flights.raw"]
    assert telemetry.key is None
    assert json.loads(telemetry.value)["location"] == "1.0,2.0"
    assert "route" not in json.loads(rejected.value) and "lat" not in json.loads(rejected.value)
    assert [r["index"] for r in to_route_index(df, "flights").collect()] == ["flights-telemetry", "flights-dlq"]
