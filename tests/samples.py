"""Hand-made rows. The base event is normal and complete and raises no alert."""

from skyledger.schemas import TELEMETRY

BASE = {
    "@timestamp": "2024-01-15T10:20:30.000Z",
    "ingest_ts": "2024-01-15T10:20:31.000Z",
    "event_type": "flight_telemetry",
    "stream": "telemetry",
    "source": "adsbfi",
    "icao24": "abc123",
    "callsign": "TST1",
    "lat": 41.9,
    "lon": 12.5,
    "baro_altitude_ft": 34000.0,
    "geo_altitude_ft": 34200.0,
    "ground_speed_kt": 440.0,
    "heading_deg": 90.0,
    "vertical_rate_fpm": 100.0,
    "squawk": "1000",
    "category": "A1",
    "on_ground": False,
}


def telemetry(spark, *changes):
    rows = [tuple((BASE | change)[name] for name in TELEMETRY.names) for change in changes]
    return spark.createDataFrame(rows, TELEMETRY)
