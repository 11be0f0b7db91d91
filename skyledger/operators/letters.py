"""Dead letters (STR-7, SNK-4): text that cannot be read goes on beside the rows made of what can.

A row of such text has it in column ``broken`` and nulls elsewhere. Operators
let it pass, so that one read and one parse serve both, and the last step sends it
to the dead-letter topic, whole and with the reason. Where there is no such column,
nothing is different.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Topics
from .bus_records import as_json

BROKEN = "broken"
UNREADABLE = "unreadable"


def carries_letters(df: DataFrame) -> bool:
    return BROKEN in df.columns


def or_broken(df: DataFrame, condition: Column) -> Column:
    """A condition that text which cannot be read passes as well."""
    return condition | F.col(BROKEN).isNotNull() if carries_letters(df) else condition


def to_bus_or_letters(
    rows: DataFrame, columns: Sequence[str], topic: Column, topics: Topics = Topics(), detector: str | None = None
) -> DataFrame:
    """Bus records of the given columns to ``topic``; of broken text, letters that name who could not read it."""
    key, value = as_json(columns)
    if not carries_letters(rows):
        return rows.select(key, value, topic.alias("topic"))
    entries = [F.col(BROKEN).alias("message"), F.lit(UNREADABLE).alias("dlq_reason")]
    if detector is not None:
        entries.append(F.lit(detector).alias("detector"))
    whole = F.col(BROKEN).isNull()
    return rows.select(
        key,
        F.when(whole, value).otherwise(F.to_json(F.struct(*entries))).alias("value"),
        F.when(whole, topic).otherwise(topics.dead_letter).alias("topic"),
    )
