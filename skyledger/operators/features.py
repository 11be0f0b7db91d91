"""Features, weak labels and class balance (FLT-5 to FLT-7, CLS-6, AGG-1 to AGG-4)."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..schemas import MODEL_NUMBERS
from .letters import BROKEN, carries_letters, or_broken
from .rules import anomalous


def model_features(events: DataFrame) -> DataFrame:
    """Events the model can read, with the hour of their day.

    Null fails the comparison and so does NaN, which sorts above all numbers. A
    Parquet scan takes such a test over; of ``dropna`` it takes nothing. Broken text
    that goes along gets values the model can read; what it says of them is not used.
    """
    known = [F.col("event_ts").isNotNull(), F.col("source").isNotNull()]
    numeric = [F.col(name) <= F.lit(math.inf) for name in MODEL_NUMBERS]
    features = events.filter(or_broken(events, reduce(and_, known + numeric))).withColumn("hour", F.hour("event_ts"))
    if not carries_letters(events):
        return features
    stand_in = {name: F.lit(0.0) for name in MODEL_NUMBERS} | {"hour": F.lit(0), "source": F.lit("")}
    return features.withColumns({name: F.when(F.col(BROKEN).isNull(), F.col(name)).otherwise(v) for name, v in stand_in.items()})


def weak_labels(features: DataFrame, bounds: Thresholds = Thresholds()) -> DataFrame:
    return features.withColumn("label", F.when(anomalous(bounds), F.lit(1.0)).otherwise(F.lit(0.0)))


def label_distribution(labelled: DataFrame) -> DataFrame:
    """AGG-1: rows per label, in order. Rows are counted before they move."""
    return labelled.groupBy("label").count().orderBy("label")


def class_balance(labelled: DataFrame) -> DataFrame:
    """AGG-2 to AGG-4 in one row, out of one pass over the data."""
    counts = labelled.groupBy("label").count()

    def rows(label: float):
        return F.coalesce(F.sum(F.when(F.col("label") == label, F.col("count"))), F.lit(0))

    return counts.agg(
        rows(1.0).alias("n_pos"), rows(0.0).alias("n_neg"), F.count("label").alias("n_classes")
    ).withColumn("w_pos", F.col("n_neg").cast("double") / F.greatest(F.col("n_pos"), F.lit(1)))


def with_weights(labelled: DataFrame, positive_weight: float) -> DataFrame:
    weight = F.when(F.col("label") == 1.0, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    return labelled.withColumn("weight", weight)
