"""Landed poll results: one JSON envelope per line (SRC-4, SRC-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.once import expand_once
from ..schemas import RAW_AIRCRAFT, SNAPSHOT

STATE_FEED = "opensky"
AC_FIRST_FEED = "airplaneslive"

_LANDED = StructType([*SNAPSHOT.fields, StructField("broken", StringType())])


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes with ``fetched_at``, the instant their file was landed.

    Taking the instant from the file, not from the clock, makes a replay give
    the same events. A line that is no envelope is kept as ``broken``.
    """
    return _with_instant(spark.read.schema(_LANDED).option("columnNameOfCorruptRecord", "broken").json(folder))


def read_snapshot_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(_LANDED).option("columnNameOfCorruptRecord", "broken")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_instant(reader.json(folder))


def _with_instant(envelopes: DataFrame) -> DataFrame:
    return envelopes.select("*", F.col("_metadata.file_modification_time").alias("fetched_at"))


def parse_snapshots(df: DataFrame, feed: str, text: str = "value") -> DataFrame:
    """Envelopes out of a column of JSON text, with the lists that the feed
    looks at; the other columns are kept."""
    keep = [name for name in df.columns if name != text]
    lists = StructType([field for field in SNAPSHOT if (field.name == "states") == (feed == STATE_FEED)])
    return expand_once(df, F.from_json(F.col(text).cast("string"), lists), keep)


def explode_snapshots(df: DataFrame, feed: str, with_broken: bool = False) -> DataFrame:
    """One row per aircraft object, or per state vector as column ``state``.

    Object feeds differ only in which of their two keys they look at first; a
    missing or empty list falls through to the other. A null or empty list
    gives no rows. ``with_broken`` a line that is no envelope gives one row, with
    nothing but its text.
    """
    keep = [name for name in df.columns if name not in SNAPSHOT.names]

    def or_one_row(entries: Column, kind: str) -> Column:
        return F.when(F.col("broken").isNotNull(), F.array(F.lit(None).cast(kind))).otherwise(entries) if with_broken else entries

    if feed == STATE_FEED:
        return df.select(*keep, F.explode(or_one_row(F.col("states"), "array<string>")).alias("state"))
    first, second = ("ac", "aircraft") if feed == AC_FIRST_FEED else ("aircraft", "ac")
    filled = _first_filled(F.col(first), F.col(second))
    return df.select(*keep, F.inline(or_one_row(filled, RAW_AIRCRAFT.simpleString())))


def _first_filled(first: Column, second: Column) -> Column:
    return F.when(F.size(first) > 0, first).otherwise(second)
