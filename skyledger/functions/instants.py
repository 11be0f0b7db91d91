"""Instants as text and back (FN-2, PRJ-10). The session zone must be UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_seconds(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_millis(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def instant(text: Column) -> Column:
    """The instant, or null for malformed text: one bad row must not end a stream."""
    return F.try_to_timestamp(text)
