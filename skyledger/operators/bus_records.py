"""Rows to bus records (PRJ-19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_json(columns: Sequence[str]) -> list[Column]:
    """A null key, which spreads records evenly, and the row as one JSON text.

    Null fields are left out of the text.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in columns])
    return [F.lit(None).cast("string").alias("key"), F.to_json(row).alias("value")]


def to_bus(df: DataFrame, topic: str | None = None) -> DataFrame:
    records = df.select(*as_json(df.columns))
    return records if topic is None else records.withColumn("topic", F.lit(topic))
