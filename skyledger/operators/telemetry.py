"""Telemetry off the bus (PRJ-1, FLT-1, FN-2, STR-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.instants import instant
from ..functions.once import expand_once
from ..schemas import TELEMETRY
from .letters import BROKEN, or_broken


def parse_telemetry(records: DataFrame) -> DataFrame:
    """Telemetry with ``event_ts``. Text that is no JSON has no stream mark, so
    the filter drops it; a malformed time gives null."""
    parsed = expand_once(records, F.from_json(F.col("value").cast("string"), TELEMETRY))
    return with_event_ts(parsed.filter(F.col("stream") == "telemetry"))


def telemetry_or_broken(records: DataFrame) -> DataFrame:
    """Telemetry as ``parse_telemetry`` gives it, and a row for each record whose text is no JSON object, which column
    ``broken`` holds; a record without text counts as empty text. One parse: only text without a stream mark is
    looked at again, for what it is."""
    text = records.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("text"))
    parsed = expand_once(text, F.from_json("text", TELEMETRY), keep=["text"])
    no_object = F.col("stream").isNull() & F.json_object_keys("text").isNull()
    parsed = expand_once(parsed, F.struct(F.when(no_object, F.col("text")).alias(BROKEN)), keep=TELEMETRY.names)
    return with_event_ts(parsed.filter(or_broken(parsed, F.col("stream") == "telemetry")))


def with_event_ts(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumn("event_ts", instant(F.col("`@timestamp`")))
