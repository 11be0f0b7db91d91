"""Training of the anomaly classifier (ML-1 to ML-6, SNK-3, SNK-7).

Runs actions, as a fit must.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..config import Thresholds, Training
from ..schemas import MODEL_NUMBERS, MODEL_VECTOR
from .features import model_features, weak_labels, with_weights
from .ranking import area_under_roc

# The forest takes the source as a category, which needs a bin for each source
# and one for those it has not seen. Numbers get as many bins, 32 at least.
LEAST_BINS = 32

_TWO_CLASSES = {"ml_attr": {"type": "binary", "name": "label"}}


class OneClassError(ValueError):
    """There is nothing to tell apart: gather more history or lower the bounds."""


class Prepared(NamedTuple):
    rows: DataFrame
    balance: Row


class Trained(NamedTuple):
    model: PipelineModel
    metrics: DataFrame
    predictions: DataFrame


def source_indexer() -> StringIndexer:
    """ML-1: frequent sources first, unseen ones in a bucket of their own."""
    return StringIndexer(inputCol="source", outputCol="source_idx", handleInvalid="keep")


def vector_assembler() -> VectorAssembler:
    """ML-2."""
    return VectorAssembler(inputCols=list(MODEL_VECTOR), outputCol="features")


def classifier(settings: Training, sources: int = 1) -> Pipeline:
    """ML-3, ML-4: preprocessing and forest as one, so that scoring shares both."""
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        numTrees=settings.trees,
        maxDepth=settings.depth,
        maxBins=max(LEAST_BINS, sources + 1),
        seed=settings.seed,
    )
    return Pipeline(stages=[source_indexer(), vector_assembler(), forest])


def in_test(settings: Training) -> Column:
    """Whether a row is for testing, as the hash of the seed and the row's aircraft, time and source says.

    The same rows are drawn whatever the order and the files they come in, and
    copies of a row stay on one side.
    """
    micros = F.unix_micros("event_ts").cast("string")
    name = F.concat_ws("|", F.lit(str(settings.seed)), F.coalesce("icao24", F.lit("")), micros, "source")
    draw = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return draw < settings.test_fraction


def split_history(history: DataFrame, settings: Training, bounds: Thresholds, table: str) -> DataFrame:
    """ML-5: labelled features, each row put into ``train`` or ``test``.

    Written down, so that the many passes of training read ten narrow columns
    in place of the whole history.
    """
    side = F.when(in_test(settings), "test").otherwise("train")
    labelled = weak_labels(model_features(history), bounds).withColumn("side", side)
    rows = labelled.select(*MODEL_NUMBERS, "hour", "source", "label", "side")
    rows.write.partitionBy("side").parquet(table)
    return history.sparkSession.read.schema(rows.schema).parquet(table)


def statistics(rows: DataFrame) -> Row:
    """Class sizes and weight, classes on the training side, and the number of sources, all in one pass."""
    counts = rows.groupBy("side", "label", "source").agg(F.count("*").alias("n"))
    size = lambda label: F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0))
    return counts.agg(
        size(1.0).alias("n_pos"),
        size(0.0).alias("n_neg"),
        F.count_distinct("label").alias("n_classes"),
        F.count_distinct(F.when(F.col("side") == "train", F.col("label"))).alias("n_learnt"),
        F.count_distinct("source").alias("sources"),
        (size(0.0) / F.greatest(size(1.0), F.lit(1))).alias("w_pos"),
    ).first()


def prepare(
    history: DataFrame, table: str, settings: Training = Training(), bounds: Thresholds = Thresholds()
) -> Prepared:
    """The archive, labelled and split, and what one pass over it counts. ``table`` is a new folder, shared by the
    executors; training and predictions read from it."""
    rows = split_history(history, settings, bounds, table)
    return Prepared(rows, statistics(rows))


def label_counts(prepared: Prepared) -> DataFrame:
    """AGG-1: rows per label, in order, from what has been counted already."""
    counts = [(0.0, prepared.balance.n_neg), (1.0, prepared.balance.n_pos)]
    return prepared.rows.sparkSession.createDataFrame([c for c in counts if c[1]], "label double, count long")


def fit(prepared: Prepared, settings: Training = Training()) -> Trained:
    rows, balance = prepared
    if balance.n_classes < 2:
        raise OneClassError("the history holds a single class")
    if balance.n_learnt < 2:
        raise OneClassError("the training side holds a single class")
    learning, held_out = rows.filter(F.col("side") == "train"), rows.filter(F.col("side") == "test")

    # Both classes weigh the same in sum. Saying that the label is binary saves
    # the forest a pass to find out.
    binary = F.col("label").alias("label", metadata=_TWO_CLASSES)
    weighted = with_weights(learning, balance.w_pos).withColumn("label", binary)
    # A fresh forest drags its training summary, and with it the session, into
    # the tasks that use it; its copy does not.
    model = classifier(settings, balance.sources).fit(weighted).copy()
    predictions = model.transform(held_out)
    metrics = rows.sparkSession.createDataFrame(
        [(area_under_roc(predictions), balance.n_pos, balance.n_neg, balance.n_classes, balance.w_pos)],
        "auc double, n_pos long, n_neg long, n_classes long, w_pos double",
    )
    return Trained(model, metrics, predictions)


def train(
    history: DataFrame, table: str, settings: Training = Training(), bounds: Thresholds = Thresholds()
) -> Trained:
    """Fit on the archive; see ``prepare``."""
    return fit(prepare(history, table, settings, bounds), settings)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def sample_predictions(predictions: DataFrame, rows: int = 20) -> DataFrame:
    """SRT-2: any few predictions, to look at."""
    return predictions.select("label", "prediction", vector_to_array("probability").alias("probability")).limit(rows)
