import json

import pytest
from samples import BASE, telemetry

from skyledger.config import Geofence, Index, Scoring, Thresholds
from skyledger.operators.bus_records import to_bus
from skyledger.operators.rules import rule_alerts
from skyledger.operators.telemetry import parse_telemetry, with_event_ts

CASES = [
    ({}, None, None),
    ({"squawk": "7500"}, "SQUAWK_HIJACK", 5),
    ({"squawk": "7600"}, "SQUAWK_RADIO_FAIL", 4),
    ({"squawk": "7700"}, "SQUAWK_EMERGENCY", 5),
    ({"baro_altitude_ft": 60000.0}, None, None),
    ({"baro_altitude_ft": 60000.1}, "ALT_OUTLIER", 4),
    ({"ground_speed_kt": 700.0}, None, None),
    ({"ground_speed_kt": 700.1}, "SPEED_OUTLIER", 4),
    ({"vertical_rate_fpm": 10000.0}, None, None),
    ({"vertical_rate_fpm": -10000.0}, None, None),
    ({"vertical_rate_fpm": 10000.1}, "VS_OUTLIER", 4),
    ({"vertical_rate_fpm": -10000.1}, "VS_OUTLIER", 4),
    ({"lat": 45.40, "lon": 9.10}, "GEOFENCE_ENTER", 3),
    ({"lat": 45.55, "lon": 9.30}, "GEOFENCE_ENTER", 3),
    ({"lat": 45.551, "lon": 9.2}, None, None),
    ({"lat": 45.5, "lon": 9.301}, None, None),
    ({"squawk": "7600", "baro_altitude_ft": 99999.0}, "SQUAWK_RADIO_FAIL", 4),
    ({"baro_altitude_ft": 99999.0, "ground_speed_kt": 999.0}, "ALT_OUTLIER", 4),
    ({"ground_speed_kt": 999.0, "vertical_rate_fpm": -99999.0}, "SPEED_OUTLIER", 4),
    ({"vertical_rate_fpm": 99999.0, "lat": 45.5, "lon": 9.2}, "VS_OUTLIER", 4),
    ({"squawk": None, "baro_altitude_ft": None, "ground_speed_kt": None, "vertical_rate_fpm": None}, None, None),
    ({"squawk": None, "baro_altitude_ft": None, "ground_speed_kt": 701.0}, "SPEED_OUTLIER", 4),
    ({"lat": None, "lon": None, "squawk": "7500"}, "SQUAWK_HIJACK", 5),
    ({"lat": None, "lon": 9.2}, None, None),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    df = telemetry(spark, *[{"callsign": str(i), **change} for i, (change, _, _) in enumerate(CASES)])
    return {int(r.callsign): r for r in rule_alerts(with_event_ts(df)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(outcomes, i):
    _, alert_type, severity = CASES[i]
    alert = outcomes.get(i)
    assert (alert and alert.alert_type, alert and alert.severity) == (alert_type, severity)
    if alert:
        assert alert.reason == f"Rule alert: {alert_type}" and alert.detector == "spark_rules"


def test_alert_record(spark):
    alert = rule_alerts(with_event_ts(telemetry(spark, {"squawk": "7700"})))
    assert alert.columns == [
        "@timestamp", "alert_generated_at", "event_type", "detector", "alert_type", "reason", "severity",
        "icao24", "callsign", "source", "lat", "lon", "raw",
    ]
    assert alert.select("raw.*").columns == [
        "baro_altitude_ft", "geo_altitude_ft", "ground_speed_kt", "heading_deg", "vertical_rate_fpm", "squawk",
        "on_ground", "ingest_ts",
    ]
    payload = json.loads(to_bus(alert).first().value)
    assert payload["@timestamp"] == BASE["@timestamp"] and payload["raw"]["squawk"] == "7700"


def test_null_fields_are_left_out_of_the_payload(spark):
    alert = rule_alerts(with_event_ts(telemetry(spark, {"squawk": "7700", "callsign": None, "@timestamp": "soon"})))
    record = to_bus(alert, "flights.alerts").first()
    assert record.key is None and record.topic == "flights.alerts"
    assert not {"callsign", "@timestamp"} & json.loads(record.value).keys()


def test_bounds_come_from_the_environment(spark):
    env = {"ALT_MAX_FT": "1000", "GEO_LAT_MIN": "0", "PROB_WARN": "0.7", "TOPICS": "a.b, c.d ", "ES_INDEX_PREFIX": "x"}
    assert Thresholds.from_env(env) == Thresholds(altitude_ft=1000.0)
    assert Geofence.from_env(env).lat_min == 0.0 and Scoring.from_env(env) == Scoring(warn=0.7)
    assert Index.from_env(env).topic_names() == ["a.b", "c.d"] and Index.from_env(env).prefix == "x"
    alerts = rule_alerts(with_event_ts(telemetry(spark, {})), Thresholds.from_env(env))
    assert alerts.first().alert_type == "ALT_OUTLIER"


def records(spark, *texts):
    return spark.createDataFrame([(t if t is None else bytearray(t.encode()),) for t in texts], "value binary")


def test_parsing_tolerates_poison(spark):
    good = json.dumps(BASE | {"unknown": 1, "lat": "41.9"})
    parsed = parse_telemetry(records(spark, good, "{", "", None, "[]", json.dumps(BASE | {"stream": "x"}))).collect()
    assert len(parsed) == 1
    # A number given as text is none.
    assert parsed[0].lat is None and parsed[0].lon == 12.5
    assert parse_telemetry(records(spark, json.dumps(BASE | {"@timestamp": "soon"}))).first().event_ts is None


def test_each_record_is_parsed_once(spark, capsys, tmp_path):
    records(spark, json.dumps(BASE)).write.parquet(str(tmp_path / "bus"))
    rule_alerts(parse_telemetry(spark.read.parquet(str(tmp_path / "bus")))).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan and "Python" not in plan
