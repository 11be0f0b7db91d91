"""The date-partitioned history (SRC-3, SNK-2)."""

from __future__ import annotations

import time
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import ARCHIVE
from ..session import path_exists

# Readers of the folder skip names that start like this.
_LOG = "_closed_days"
_NOTES = "event_date date, files array<string>, noted long"
# How Spark names the folder of a null (fixed value).
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_archive(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The history, or the given days of it, both ends included.

    The bounds are on the partition column, so other days are not opened.
    """
    return _within(spark.read.schema(ARCHIVE).parquet(path).select(*ARCHIVE.names), first, last)


def write_archive(history: DataFrame, path: str) -> None:
    """Append a finite history: a replay of the bus, or the rewrite of days that
    a stream left in many small files. Not for a folder a stream writes to,
    whose readers see the files of the stream only.

    Rebalancing collects each day into files of a good size and, unlike a plain
    repartitioning by day, splits a day that is too big for one task.
    """
    history.hint("rebalance", F.col("event_date")).write.mode("append").partitionBy("event_date").parquet(path)


def compact_archive(
    spark: SparkSession, path: str, target: str, first: date | None = None, last: date | None = None
) -> None:
    """Rewrite days of a streamed archive into fewer, larger files of another folder, and close them.

    Days that are closed and have got no file since are skipped. A day is taken whole from ``path``, in place of what
    ``target`` held of it. It is closed when it has been written, with the names of the files it was made from, and
    not before: if the job ends in between, ``read_history`` goes on reading the day from ``path``. One compaction at
    a time.
    """
    days = days_to_close(spark, path, target, first, last)
    if days:
        rewrite_days(spark, path, target, days)
        _note(spark, target, days)


def days_to_close(
    spark: SparkSession, path: str, target: str, first: date | None = None, last: date | None = None
) -> dict[date | None, list[str]]:
    """The files of each day, from ``first`` to ``last``, that is not closed or has got files since."""
    closed = closed_days(spark, target)
    asked = {
        day: files
        for day, files in _files_by_day(spark, path).items()
        if (first is None or day is not None and day >= first) and (last is None or day is not None and day <= last)
    }
    return {day: files for day, files in asked.items() if not {_name(f) for f in files} <= closed.get(day, set())}


def rewrite_days(spark: SparkSession, path: str, target: str, days: dict[date | None, list[str]]) -> None:
    """Write the given files of days anew, each day in place of what ``target`` has of it. The days are open from
    here until they are noted as closed."""
    _note(spark, target, dict.fromkeys(days))
    rows = _read_files(spark, path, [f for files in days.values() for f in files])
    writer = rows.hint("rebalance", F.col("event_date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date").parquet(target)


def closed_days(spark: SparkSession, target: str) -> dict[date | None, set[str]]:
    """Of each closed day, the names of the files it was made from. As many names come to the driver as the
    streamed folder has files, whose list the driver has to hold in any case."""
    folder = f"{target}/{_LOG}"
    if not path_exists(spark, folder):
        return {}
    newest = spark.read.schema(_NOTES).parquet(folder).groupBy("event_date").agg(F.max_by("files", "noted").alias("files"))
    return {r.event_date: set(r.files) for r in newest.collect() if r.files is not None}


def read_history(
    spark: SparkSession, path: str, target: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """A streamed archive and its closed days as one history, each event once.

    A closed day is read from ``target``, any other from ``path``, and so are files that a closed day has got since,
    such as those of late events. The bounds are as for ``read_archive``.
    """
    closed = closed_days(spark, target)
    if not closed:
        return read_archive(spark, path, first, last)
    day = F.col("event_date")
    # Null is the day of events whose time cannot be read.
    is_closed = F.when(day.isNull(), F.lit(None in closed)).otherwise(day.isin([d for d in closed if d is not None]))
    parts = [read_archive(spark, target, first, last).filter(is_closed), read_archive(spark, path, first, last).filter(~is_closed)]
    late = [f for d, files in _files_by_day(spark, path).items() if d in closed for f in files if _name(f) not in closed[d]]
    if late:
        parts.append(_within(_read_files(spark, path, late), first, last))
    return reduce(DataFrame.unionByName, parts)


def _note(spark: SparkSession, target: str, days: dict[date | None, list[str] | None]) -> None:
    """Note days as closed, with their files, or as open, without. The last note of a day holds; each call is one
    file, which is there whole or not at all."""
    now = time.time_ns()
    notes = [(day, None if files is None else [_name(f) for f in files], now) for day, files in days.items()]
    spark.createDataFrame(notes, _NOTES).coalesce(1).write.mode("append").parquet(f"{target}/{_LOG}")


def _files_by_day(spark: SparkSession, path: str) -> dict[date | None, list[str]]:
    """The committed files of an archive, from its listing; none is opened."""
    found: dict[date | None, list[str]] = {}
    for file in read_archive(spark, path).inputFiles():
        value = next(p for p in reversed(file.split("/")) if p.startswith("event_date=")).removeprefix("event_date=")
        found.setdefault(None if value == _NO_DAY else date.fromisoformat(value), []).append(file)
    return found


def _read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.schema(ARCHIVE).option("basePath", path).parquet(*files).select(*ARCHIVE.names)


def _name(file: str) -> str:
    return file.rsplit("/", 1)[-1]


def _within(history: DataFrame, first: date | None, last: date | None) -> DataFrame:
    if first is not None:
        history = history.filter(F.col("event_date") >= F.lit(first))
    if last is not None:
        history = history.filter(F.col("event_date") <= F.lit(last))
    return history


def archive_stream(history: DataFrame, path: str) -> DataStreamWriter:
    """Append a stream, each file exactly once; no shuffle."""
    return history.writeStream.format("parquet").option("path", path).partitionBy("event_date").outputMode("append")
