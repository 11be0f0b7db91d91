import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from skyledger.config import Scoring, Thresholds, Training
from skyledger.operators.features import model_features
from skyledger.operators.learning import (
    OneClassError,
    label_counts,
    prepare,
    sample_predictions,
    save_model,
    split_history,
    train,
)
from skyledger.operators.ranking import area_under_roc, rank_sums
from skyledger.operators.scoring import model_alerts, score
from skyledger.plans import feeds
from skyledger.session import scratch

SETTINGS = Training(trees=15)


@pytest.fixture(scope="module")
def history(spark):
    """Visible outliers only, so that the forest can find all of them."""
    n = F.col("id")
    return spark.range(0, 4000, 1, 4).select(
        F.timestamp_seconds(1704067200 + n * 60).alias("event_ts"),
        F.concat(F.lit("feed"), n % 3).alias("source"),
        F.concat(F.lit("a"), n).alias("icao24"),
        F.lit(None).cast("string").alias("callsign"),
        (41.0 + n % 100 / 100).alias("lat"),
        (12.0 + n % 70 / 100).alias("lon"),
        F.when(n % 40 == 7, 70000.0).otherwise(30000.0 + n % 5000).alias("baro_altitude_ft"),
        F.when(n % 50 == 9, 800.0).otherwise(400.0 + n % 80).alias("ground_speed_kt"),
        (n % 360).cast("double").alias("heading_deg"),
        (n % 1000 - 500.0).alias("vertical_rate_fpm"),
        F.lit("1000").alias("squawk"),
        F.lit(None).cast("string").alias("ingest_ts"),
    )


@pytest.fixture(scope="module")
def trained(spark, history):
    return train(history, scratch(spark, "test-training"), SETTINGS)


def test_rules_are_learnt_in_spite_of_the_imbalance(trained):
    metrics = trained.metrics.first()
    assert metrics.auc > 0.99 and metrics.n_classes == 2
    assert metrics.w_pos == metrics.n_neg / metrics.n_pos and metrics.n_pos + metrics.n_neg == 4000
    sample = sample_predictions(trained.predictions).collect()
    assert len(sample) == 20 and all(abs(sum(r.probability) - 1) < 1e-9 for r in sample)


def test_reloaded_model_scores_alike(spark, history, trained):
    path = scratch(spark, "test-model")
    save_model(trained.model, path)
    save_model(trained.model, path)
    features = model_features(history)

    def scores(model):
        return {r.icao24: (r.prediction, r.p_anom) for r in score(features, model).collect()}

    assert scores(PipelineModel.load(path)) == scores(trained.model)


def test_alerts_grade_by_probability(history, trained):
    features = model_features(history)
    scored = score(features, trained.model)
    assert scored.columns == [*features.columns, "prediction", "p_anom"]
    expected = {r.icao24: r.p_anom for r in scored.collect() if r.prediction == 1.0 and r.p_anom >= 0.6}
    alerts = model_alerts(scored).collect()
    assert {a.icao24: a.raw.p_anom for a in alerts} == expected and len(alerts) > 50
    for alert in alerts:
        assert alert.severity == (4 if alert.raw.p_anom >= 0.85 else 3)
        assert alert.reason == f"ML anomaly p={alert.raw.p_anom:.3f}"
        assert (alert.detector, alert.alert_type) == ("spark_ml", "FLIGHT_ANOMALY_ML")
    assert model_alerts(scored, Scoring(warn=1.1)).count() == 0


def test_bounds_of_the_levels_are_inclusive(spark, history, trained):
    fixed = spark.createDataFrame(
        [(0, 0.6, 1.0), (1, 0.599, 1.0), (2, 0.85, 1.0), (3, 0.9, 0.0)], "n long, p_anom double, prediction double"
    )
    events = model_features(history).withColumn("n", F.expr("(unix_seconds(event_ts) - 1704067200) div 60"))
    alerts = model_alerts(events.join(fixed, "n")).collect()
    assert sorted((a.raw.p_anom, a.severity) for a in alerts) == [(0.6, 3), (0.85, 4)]


def test_unseen_source_is_scored(history, trained):
    strange = model_features(history.limit(5).withColumn("source", F.lit("never seen")))
    assert score(strange, trained.model).count() == 5


def test_forest_runs_once_per_row(history, trained, capsys):
    model_alerts(score(model_features(history), trained.model)).explain()
    plan = capsys.readouterr().out
    assert plan.count("UDF(features") == 1 and "Exchange" not in plan


def test_split_is_written_down(spark, history):
    rows = split_history(history, SETTINGS, Thresholds(), scratch(spark, "test-split"))
    assert rows.count() == 4000
    sides = {r.side: r["count"] for r in rows.groupBy("side").count().collect()}
    assert 700 < sides["test"] < 900
    # Another layout of the same rows is split alike, and copies of a row stay together.
    other = history.orderBy(F.xxhash64("icao24")).repartition(3)
    again = split_history(other.unionByName(history), SETTINGS, Thresholds(), scratch(spark, "test-split"))
    assert {r.side: r["count"] for r in again.groupBy("side").count().collect()} == {k: 2 * n for k, n in sides.items()}


def test_one_class_cannot_be_learnt(spark, history):
    with pytest.raises(OneClassError):
        train(history.filter("baro_altitude_ft < 60000 AND ground_speed_kt < 700"), scratch(spark, "test-one"), SETTINGS)


def test_many_sources_are_told_apart(spark, history):
    many = history.withColumn("source", F.expr("'s' || (unix_seconds(event_ts) div 60) % 64"))
    trained = train(many, scratch(spark, "test-many"), SETTINGS)
    assert trained.metrics.first().auc > 0.95
    assert len(trained.model.stages[0].labels) == 64


def pairs_won(rows):
    pairs = [(p, q) for p, a in rows for q, b in rows if a == 1.0 and b == 0.0]
    return sum((p > q) + (p == q) / 2 for p, q in pairs) / len(pairs)


@pytest.mark.parametrize("spread", [3, 40, 100_000])
def test_exact_area_under_curve(spark, spread):
    rows = [((k * 7919 + k * k) % spread / 10, float(k % 5 == 0 or k % 7 == k % 3)) for k in range(500)]
    df = spark.createDataFrame(rows, "score double, label double").repartition(7)
    assert area_under_roc(df, "score") == pytest.approx(pairs_won(rows), abs=1e-15)
    assert rank_sums(df).count() <= 8


def test_a_third_of_all_rows_may_tie(spark):
    df = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 300_000).alias("score"), (F.col("id") % 2).cast("double").alias("label"))
    curve = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert area_under_roc(df, "score") == pytest.approx(curve, abs=1e-12)


def test_area_of_odd_scores(spark):
    def area(*rows):
        return area_under_roc(spark.createDataFrame(rows, "score double, label double"), "score")

    assert area((float("nan"), 1.0), (1e300, 0.0), (None, 0.0), (0.3, None)) == 1.0
    assert area((0.0, 1.0), (-0.0, 0.0)) == 0.5
    assert math.isnan(area((0.5, 1.0), (0.6, 1.0))) and math.isnan(area((None, None)))


def test_the_positive_class_of_a_vector_is_scored(trained):
    reported = trained.metrics.first().auc
    assert reported == area_under_roc(trained.predictions, "probability") == area_under_roc(trained.predictions)


def test_labels_are_counted_once(spark, history):
    prepared = prepare(history, scratch(spark, "test-counts"), SETTINGS)
    counted = {r.label: r["count"] for r in label_counts(prepared).collect()}
    assert counted == {1.0: prepared.balance.n_pos, 0.0: prepared.balance.n_neg} and sum(counted.values()) == 4000


def test_no_task_holds_all_scores(spark, capsys):
    rank_sums(spark.range(10).select(F.col("id").alias("score"), (F.col("id") % 2).alias("label"))).explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_the_feed_of_the_model_makes_each_value_once(spark, tmp_path):
    start = datetime(2024, 1, 15, 10)
    rows = [(k, start + timedelta(minutes=k), k % 7, "view", 1.0, "{}") for k in range(300)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    plain, once = feeds.telemetry(spark, str(tmp_path)), feeds.telemetry_once(spark, str(tmp_path))
    assert once.columns == plain.columns and once.count() > 0
    assert not once.exceptAll(plain).count() and not plain.exceptAll(once).count()
    plan = feeds.fixed_scores(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "date_format" in line]
