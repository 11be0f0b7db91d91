"""Alerts off the bus to index documents (PRJ-21 to PRJ-23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import ALERT_DOCUMENT
from .alerts import parse_alerts

# Offsets per folder of the index table. Records without offsets are in a folder
# per day, whose name is the negative of the day.
BLOCK = 1_000_000


def index_name(topic: Column, prefix: str) -> Column:
    """PRJ-21: what follows the first dot of the topic, or all of it."""
    dot = F.instr(topic, ".")
    return F.concat(F.lit(f"{prefix}-"), F.when(dot > 0, F.substring(topic, dot + 1, F.length(topic))).otherwise(topic))


def alert_documents(
    records: DataFrame, prefix: str = "flights", counters: str | Observation | None = None
) -> DataFrame:
    """One document per alert, named after its place on the bus.

    A record without an offset is named after the file and row it was read
    from. Records that are no JSON object are counted and left out. What a record
    says stays with its document as a value of any shape, ``document``, with the fields
    the table has no column for; ``unmapped`` reads them.
    Its ``version`` is the record's time on the bus, its ``fingerprint`` a hash of the text.
    """
    missing = {"record_id": "string", "record_day": "long", "timestamp": "timestamp"}
    records = records.withColumns(
        {"text": F.col("value").cast("string")}
        | {name: F.lit(None).cast(kind) for name, kind in missing.items() if name not in records.columns}
    )
    parsed = parse_alerts(records, keep=["topic", "partition", "offset", "text", *missing])
    readable = F.col("readable")
    if counters is not None:
        parsed = parsed.observe(
            counters, F.count_if(readable).alias("indexed"), F.count_if(~readable).alias("unreadable")
        )
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    placed = F.col("offset").isNotNull()
    nameless = F.raise_error(F.lit("a bus record without an offset, a file and a row cannot be told from others"))
    by_row = F.when(F.col("record_id").isNull(), nameless.cast("string")).otherwise(F.concat_ws("-", "topic", "record_id"))
    return (
        parsed.filter(readable)
        .withColumns(
            {
                "doc_id": F.when(placed, F.concat_ws("-", "topic", "partition", "offset")).otherwise(by_row),
                "version": F.col("timestamp"),
                # An object that has a key twice is no such value; its text is.
                "document": F.coalesce(F.try_parse_json("text"), F.col("text").cast("variant")),
                "fingerprint": F.xxhash64("text"),
                "location": F.when(located, F.struct("lat", "lon")),
                "index": index_name(F.col("topic"), prefix),
                "offset_block": F.when(placed, F.expr(f"offset div {BLOCK}")).otherwise(-F.col("record_day")),
            }
        )
        .select(*[F.col(f"`{name}`") for name in ALERT_DOCUMENT.names])
    )


def unmapped(path: str, kind: str) -> Column:
    """A field of an indexed document that the table has no column for, by its JSON path; null where it is not there or
    of another kind."""
    return F.try_variant_get(F.col("document"), path, kind)
