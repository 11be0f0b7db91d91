import json
import math
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from skyledger.functions.text import BLANKS, number, strip, truthy
from skyledger.operators.normalize import normalize, normalize_objects, normalize_states
from skyledger.schemas import NORMALIZED, RAW_AIRCRAFT
from skyledger.sources.snapshots import explode_snapshots, parse_snapshots, read_snapshots

AIRCRAFT = {
    "hex": " AbC123 ",
    "flight": "AZA12  ",
    "lat": "41.9",
    "lon": "12.5",
    "alt_baro": "34000",
    "alt_geom": "34200",
    "gs": "440.5",
    "track": "90",
    "baro_rate": "-64",
    "squawk": " 7700",
    "category": "A3",
}


def noon():
    return F.lit(datetime(2024, 1, 15, 12)).cast("timestamp")


def objects(spark, *changes):
    rows = [tuple((AIRCRAFT | c)[name] for name in RAW_AIRCRAFT.names) for c in changes]
    return normalize_objects(spark.createDataFrame(rows, RAW_AIRCRAFT), "adsbfi", noon())


def states(spark, *vectors):
    return normalize_states(spark.createDataFrame([(list(v),) for v in vectors], "state array<string>"), noon())


def vector(**at):
    values = [None] * 17
    values[0] = "4ca1fa"
    for position, value in at.items():
        values[int(position[1:])] = value
    return values


def test_object(spark):
    row = objects(spark, {})
    assert row.schema.names == NORMALIZED.names
    assert [f.dataType for f in row.schema] == [f.dataType for f in NORMALIZED]
    assert tuple(row.first()) == (
        "2024-01-15T12:00:00Z",
        "adsbfi",
        "abc123",
        "AZA12",
        41.9,
        12.5,
        34000.0,
        34200.0,
        440.5,
        90.0,
        -64.0,
        "7700",
        "A3",
        False,
    )


@pytest.mark.parametrize("hex_", [None, "", "   ", "\t "])
def test_object_without_identifier_is_dropped(spark, hex_):
    assert objects(spark, {"hex": hex_}).count() == 0


def test_object_oddities(spark):
    ground, upper, unknown, blank = objects(
        spark, {"alt_baro": "ground"}, {"alt_baro": "GROUND"}, {"alt_baro": None, "gs": "n/a"}, {"flight": "  ", "squawk": " "}
    ).collect()
    assert ground.on_ground and ground.baro_altitude_ft is None
    assert upper.on_ground
    assert unknown.on_ground is False and unknown.baro_altitude_ft is None and unknown.ground_speed_kt is None
    assert blank.callsign is None and blank.squawk == ""
    assert objects(spark, {"squawk": None}).first().squawk is None


def test_state_is_converted_from_metric_units(spark):
    row = states(
        spark,
        vector(p1="ITY1 ", p5="12.5", p6="41.9", p7="1000", p8="true", p9="100", p10="270", p11="-5", p13="1010", p14=" 7500"),
    ).first()
    assert (row.lat, row.lon, row.heading_deg, row.source, row.category) == (41.9, 12.5, 270.0, "opensky", None)
    assert row.baro_altitude_ft == 1000 * 3.28084 and row.geo_altitude_ft == 1010 * 3.28084
    assert row.ground_speed_kt == 100 * 1.94384 and row.vertical_rate_fpm == -5 * 196.85
    assert row.on_ground is True and row.squawk == "7500" and row.callsign == "ITY1"


def test_state_callsign_may_be_blank_but_not_empty(spark):
    blank, empty, missing = states(spark, vector(p1="   "), vector(p1=""), vector()).collect()
    assert (blank.callsign, empty.callsign, missing.callsign) == ("", None, None)


def test_short_or_dirty_states_keep_their_row(spark):
    short, dirty = states(spark, ["4ca1fa", "ITY1"], vector(p7="high", p9="")).collect()
    assert short.icao24 == "4ca1fa" and short.lat is None and short.on_ground is False
    assert dirty.baro_altitude_ft is None and dirty.ground_speed_kt is None
    assert states(spark, [None, "ITY1"], []).count() == 0


def test_text_functions_agree_with_python(spark):
    texts = ["", " ", " a b ", " x　", "\x1cq\x85", BLANKS, "é ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(strip(F.col("t")))
    assert [r[0] for r in df.collect()] == [None if t is None else t.strip() for t in texts]
    assert set(BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    odd = ["1d", "2F", "3.f ", "0x1p3d", "1_0", "true", "d", "1e3D", "fd"]
    df = spark.createDataFrame([(t,) for t in odd], "t string").select(number(F.col("t")))
    assert [r[0] for r in df.collect()] == [None] * len(odd)
    df = spark.createDataFrame([(t,) for t in ("inf", " -Infinity", "+INF ", "infin")], "t string").select(number(F.col("t")))
    assert [r[0] for r in df.collect()] == [math.inf, -math.inf, math.inf, None]
    numbers = ["1", " 2.5 ", "1e3", "ground", "", None, "-0"]
    df = spark.createDataFrame([(t,) for t in numbers], "t string").select(number(F.col("t")))
    assert [r[0] for r in df.collect()] == [1.0, 2.5, 1000.0, None, None, None, 0.0]
    flags = ["true", "false", "1", "0", "0.0", "", "yes", None]
    df = spark.createDataFrame([(t,) for t in flags], "t string").select(truthy(F.col("t")))
    assert [r[0] for r in df.collect()] == [True, False, True, False, False, False, True, False]


def envelope(**lists):
    return json.dumps({k: [{"hex": h} for h in v] if v is not None else None for k, v in lists.items()})


def test_lists_fall_through_when_empty(spark):
    texts = [
        envelope(aircraft=["a1"], ac=["b1"]),
        envelope(aircraft=[], ac=["b2"]),
        envelope(ac=["b3"]),
        envelope(aircraft=["a4"], ac=[]),
        envelope(aircraft=None, ac=None),
        "{",
    ]
    df = parse_snapshots(spark.createDataFrame([(t,) for t in texts], "value string"), "adsbfi")
    assert [r.hex for r in explode_snapshots(df, "adsbfi").collect()] == ["a1", "b2", "b3", "a4"]
    assert [r.hex for r in explode_snapshots(df, "airplaneslive").collect()] == ["b1", "b2", "b3", "a4"]


def test_landed_files_with_mixed_types(spark, tmp_path):
    poll = {
        "ac": [{"hex": "a1", "alt_baro": "ground", "lat": 41.5, "lon": 12}, {"hex": "a2", "alt_baro": 1200, "squawk": 1200}],
        "states": [["c1", None, "Italy", 1, 2, 12.5, 41.9, 300.5, True, 99, 10, None, None, 310], ["c2"]],
    }
    (tmp_path / "poll.json").write_text(json.dumps(poll) + "\n" + json.dumps({"ac": None, "states": None}) + "\n")
    df = read_snapshots(spark, str(tmp_path))
    first, second = normalize(df, "anything", F.col("fetched_at")).orderBy("icao24").collect()
    assert (first.source, first.on_ground, first.lat, first.lon) == ("anything", True, 41.5, 12.0)
    assert (second.baro_altitude_ft, second.squawk, second.on_ground) == (1200.0, "1200", False)
    assert first.event_time.endswith("Z") and len(first.event_time) == 20
    c1, c2 = normalize(df, "opensky").orderBy("icao24").collect()
    assert c1.on_ground and c1.lat == 41.9 and c1.baro_altitude_ft == 300.5 * 3.28084 and c2.lat is None


def test_counters_see_what_is_dropped(spark):
    rows = [tuple((AIRCRAFT | {"hex": h})[n] for n in RAW_AIRCRAFT.names) for h in ("a", None, " ")]
    counters = Observation("ingest")
    df = normalize_objects(spark.createDataFrame(rows, RAW_AIRCRAFT), "adsbfi", noon(), counters=counters)
    assert df.count() == 1
    assert counters.get == {"fetched": 3, "sent": 1}
