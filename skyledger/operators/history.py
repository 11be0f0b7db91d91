"""Telemetry to archive rows (FLT-2, FN-3, PRJ-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ARCHIVE


def to_archive(telemetry: DataFrame) -> DataFrame:
    """Located events only; an unreadable time goes to the null date."""
    located = telemetry.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return located.withColumn("event_date", F.to_date("event_ts")).select(*ARCHIVE.names)
