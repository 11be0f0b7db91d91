"""Row types that cross a boundary: landed file, bus, archive, index.

Field names, types and order are fixed values of the data contract.
"""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)


def _struct(**types) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


TEXT, NUMBER, FLAG = StringType(), DoubleType(), BooleanType()

# Feeds mix numbers and words in one field, so every raw field is read as text.
RAW_AIRCRAFT = _struct(
    hex=TEXT,
    flight=TEXT,
    lat=TEXT,
    lon=TEXT,
    alt_baro=TEXT,
    alt_geom=TEXT,
    gs=TEXT,
    track=TEXT,
    baro_rate=TEXT,
    squawk=TEXT,
    category=TEXT,
)

SNAPSHOT = _struct(
    aircraft=ArrayType(RAW_AIRCRAFT),
    ac=ArrayType(RAW_AIRCRAFT),
    states=ArrayType(ArrayType(TEXT)),
)

MOTION = {
    "baro_altitude_ft": NUMBER,
    "geo_altitude_ft": NUMBER,
    "ground_speed_kt": NUMBER,
    "heading_deg": NUMBER,
    "vertical_rate_fpm": NUMBER,
}

NORMALIZED = _struct(
    event_time=TEXT,
    source=TEXT,
    icao24=TEXT,
    callsign=TEXT,
    lat=NUMBER,
    lon=NUMBER,
    **MOTION,
    squawk=TEXT,
    category=TEXT,
    on_ground=FLAG,
)

TELEMETRY = _struct(
    **{"@timestamp": TEXT},
    ingest_ts=TEXT,
    event_type=TEXT,
    stream=TEXT,
    source=TEXT,
    icao24=TEXT,
    callsign=TEXT,
    lat=NUMBER,
    lon=NUMBER,
    **MOTION,
    squawk=TEXT,
    category=TEXT,
    on_ground=FLAG,
)

ARCHIVE = _struct(
    event_ts=TimestampType(),
    event_date=DateType(),
    source=TEXT,
    icao24=TEXT,
    callsign=TEXT,
    lat=NUMBER,
    lon=NUMBER,
    **MOTION,
    squawk=TEXT,
    category=TEXT,
    on_ground=FLAG,
    ingest_ts=TEXT,
)

# What the two detectors put under "raw", as one type: a detector leaves out
# the fields it does not know.
ALERT_DETAIL = _struct(
    **MOTION,
    squawk=TEXT,
    on_ground=FLAG,
    p_anom=NUMBER,
    ingest_ts=TEXT,
)

ALERT = _struct(
    **{"@timestamp": TimestampType()},
    alert_generated_at=TimestampType(),
    event_type=TEXT,
    detector=TEXT,
    alert_type=TEXT,
    reason=TEXT,
    severity=IntegerType(),
    icao24=TEXT,
    callsign=TEXT,
    source=TEXT,
    lat=NUMBER,
    lon=NUMBER,
    raw=ALERT_DETAIL,
)

BUS_RECORD = _struct(
    key=BinaryType(),
    value=BinaryType(),
    topic=TEXT,
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
)

NAMED_BUS_RECORD = StructType([*BUS_RECORD.fields, StructField("record_id", TEXT), StructField("record_day", LongType())])

ALERT_DOCUMENT = StructType(
    [StructField("doc_id", TEXT), StructField("partition", IntegerType()), StructField("offset", LongType())]
    + ALERT.fields
    + [StructField("location", _struct(lat=NUMBER, lon=NUMBER))]
    + [StructField("document", VariantType()), StructField("version", TimestampType()), StructField("fingerprint", LongType())]
    + [StructField("index", TEXT), StructField("offset_block", LongType())]
)

# Inputs of the classifier in vector order; "hour" and "source_idx" are derived.
MODEL_NUMBERS = ("baro_altitude_ft", "ground_speed_kt", "vertical_rate_fpm", "heading_deg", "lat", "lon")
MODEL_VECTOR = (*MODEL_NUMBERS, "hour", "source_idx")
