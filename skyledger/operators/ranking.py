"""The exact area under the ROC curve of a distributed table (AGG-5)."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_number(df: DataFrame, name: str) -> Column:
    """A score, or of a vector of one score per class that of the positive class."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return F.get(vector_to_array(name), F.lit(1))
    return F.col(name).cast("double")


def rank_sums(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """A row per range of scores, ascending: ``part``, its positives and negatives, and ``wins``, which counts each pair
    of a positive and a negative of that range by 2 where the positive has the higher score and by 1 where they tie.

    Rows are added up by score before they move, so equal scores of any number are one row. These are dealt by range
    and summed up within each; what lies below a range is for the reader of the few rows to add.
    """
    positive = F.col(label) > 0.5
    known = scored.select(positive.alias("positive"), _as_number(scored, score).alias("score")).filter(
        F.col("positive").isNotNull() & F.col("score").isNotNull()
    )
    counts = known.groupBy("score").agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    ranges = counts.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    below = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    beaten = 2 * F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg")
    # Pairs outnumber what a long can hold.
    wins = F.col("pos").cast("decimal(19,0)") * beaten.cast("decimal(19,0)")
    return (
        ranges.withColumn("wins", wins)
        .groupBy("part")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .orderBy("part")
    )


def area_under_roc(scored: DataFrame, score: str = "rawPrediction", label: str = "label") -> float:
    """The share of pairs of a positive and a negative in which the positive scores higher, ties counting half.

    Exact whatever the number of scores; NaN is above all numbers. Rows without a label or a score are left out. NaN
    where a class is missing. One row per shuffle partition comes to the driver.
    """
    wins = negatives = positives = 0
    for row in rank_sums(scored, label, score).collect():
        wins += int(row.wins) + 2 * row.pos * negatives
        negatives += row.neg
        positives += row.pos
    return float(Fraction(wins, 2 * positives * negatives)) if positives and negatives else math.nan
