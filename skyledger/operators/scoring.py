"""Model-based detection (ML-7, FLT-9, FLT-10, CLS-4, CLS-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Scoring
from ..functions.once import expand_once
from .alerts import alert_records
from .letters import or_broken

DETAIL = (
    "baro_altitude_ft",
    "ground_speed_kt",
    "vertical_rate_fpm",
    "heading_deg",
    "squawk",
    "p_anom",
    "ingest_ts",
)


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Features with ``prediction`` and ``p_anom``, the probability of an anomaly."""
    anomaly = F.get(vector_to_array("probability"), F.lit(1))
    outcome = F.struct("prediction", anomaly.alias("p_anom"))
    return expand_once(model.transform(features), outcome, keep=features.columns)


def model_alerts(scored: DataFrame, levels: Scoring = Scoring(), keep: Sequence[str] = ()) -> DataFrame:
    chance = F.col("p_anom")
    positive = scored.filter(or_broken(scored, (F.col("prediction") == 1.0) & (chance >= levels.warn)))
    return alert_records(
        positive,
        "spark_ml",
        F.lit("FLIGHT_ANOMALY_ML"),
        F.concat(F.lit("ML anomaly p="), F.format_number(chance, 3)),
        F.when(chance >= levels.critical, 4).otherwise(3),
        DETAIL,
        keep,
    )
