import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F
from samples import BASE, telemetry

from skyledger.operators.features import class_balance, label_distribution, model_features, weak_labels, with_weights
from skyledger.operators.history import to_archive
from skyledger.operators.telemetry import with_event_ts
from skyledger.schemas import ARCHIVE, MODEL_NUMBERS
from skyledger.sources import archive
from skyledger.sources.archive import (
    closed_days,
    compact_archive,
    days_to_close,
    read_archive,
    read_history,
    write_archive,
)


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_archive_roundtrip(spark, tmp_path, capsys):
    days = [{"@timestamp": f"2024-01-{d:02d}T23:59:59.000Z"} for d in (1, 2, 2, 3)]
    df = with_event_ts(telemetry(spark, *days, {"@timestamp": "soon"}, {"lat": None}, {"lon": None}))
    path = str(tmp_path / "archive")
    write_archive(to_archive(df), path)
    back = read_archive(spark, path)
    assert back.columns == ARCHIVE.names
    dates = [r.event_date for r in back.orderBy("event_ts").collect()]
    # An unreadable time is kept under no date; a missing position is not kept.
    assert dates == [None, date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2), date(2024, 1, 3)]
    middle = read_archive(spark, path, date(2024, 1, 2), date(2024, 1, 2))
    assert middle.count() == 2
    plan = plan_of(middle.select("lat"), capsys)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "ReadSchema: struct<lat:double>" in plan


def test_a_hot_day_is_split_over_tasks(spark, tmp_path):
    """One day holds nearly all rows and still goes to more than one file."""
    minute = F.make_timestamp(F.lit(2024), F.lit(1), F.when(F.col("id") % 50 == 0, 1).otherwise(2), F.lit(0), F.lit(0), F.lit(0))
    rows = spark.range(0, 200_000, 1, 4).withColumns(
        {"event_ts": minute, "lat": F.rand(1), "lon": F.rand(2), "icao24": F.sha2(F.col("id").cast("string"), 256)}
    )
    missing = [f for f in ARCHIVE.fields if f.name not in (*rows.columns, "event_date")]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_archive(to_archive(rows), str(tmp_path / "archive"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "archive" / "event_date=2024-01-02").glob("*.parquet"))) > 1
    assert len(list((tmp_path / "archive" / "event_date=2024-01-01").glob("*.parquet"))) <= 2
    assert read_archive(spark, str(tmp_path / "archive")).count() == 200_000


@pytest.mark.parametrize("name", [*MODEL_NUMBERS, "source"])
def test_incomplete_events_are_no_features(spark, name):
    changes = [{name: None}, {}] if name == "source" else [{name: None}, {name: float("nan")}, {}]
    features = model_features(with_event_ts(telemetry(spark, *changes)))
    assert [r.hour for r in features.collect()] == [10]


def test_infinity_is_a_number(spark):
    assert model_features(with_event_ts(telemetry(spark, {"heading_deg": float("inf")}))).count() == 1


def test_unreadable_time_is_no_feature(spark):
    assert model_features(with_event_ts(telemetry(spark, {"@timestamp": "soon"}))).count() == 0


def test_missing_position_and_category_do_not_matter_to_rules_but_to_features(spark, tmp_path, capsys):
    write_archive(to_archive(with_event_ts(telemetry(spark, {}, {"category": None}))), str(tmp_path / "a"))
    features = model_features(read_archive(spark, str(tmp_path / "a")))
    assert features.count() == 2
    plan = plan_of(features.select("hour"), capsys)
    assert "IsNotNull(baro_altitude_ft)" in plan and "LessThanOrEqual(lat,Infinity)" in plan
    assert "category" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize(
    "change,label",
    [
        ({}, 0.0),
        ({"squawk": "7500"}, 1.0),
        ({"squawk": "7600"}, 1.0),
        ({"squawk": "7700"}, 1.0),
        ({"squawk": None}, 0.0),
        ({"squawk": None, "ground_speed_kt": 700.5}, 1.0),
        ({"baro_altitude_ft": 60000.0}, 0.0),
        ({"baro_altitude_ft": 60001.0}, 1.0),
        ({"vertical_rate_fpm": -10001.0}, 1.0),
        ({"lat": 45.5, "lon": 9.2}, 0.0),
    ],
)
def test_weak_label(spark, change, label):
    assert weak_labels(telemetry(spark, change)).first().label == label


def labels(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "label double")


def test_class_balance(spark):
    both = labels(spark, 1.0, 0.0, 0.0, 0.0)
    assert class_balance(both).first().asDict() == {"n_pos": 1, "n_neg": 3, "n_classes": 2, "w_pos": 3.0}
    assert class_balance(labels(spark, 0.0, 0.0)).first().asDict() == {"n_pos": 0, "n_neg": 2, "n_classes": 1, "w_pos": 2.0}
    assert class_balance(labels(spark)).first().asDict() == {"n_pos": 0, "n_neg": 0, "n_classes": 0, "w_pos": 0.0}
    assert [tuple(r) for r in label_distribution(both).collect()] == [(0.0, 3), (1.0, 1)]
    assert sorted(r.weight for r in with_weights(both, 3.0).collect()) == [1.0, 1.0, 1.0, 3.0]


def test_base_event_is_complete():
    assert None not in BASE.values()


def day_rows(spark, *times):
    return to_archive(with_event_ts(telemetry(spark, *[{"@timestamp": t, "icao24": f"a{k}"} for k, t in enumerate(times)])))


T = "2024-01-{:02d}T10:00:00Z".format


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "streamed"), str(tmp_path / "closed")


def times(df):
    return sorted(str(r.event_ts)[:10] for r in df.collect())


def test_closed_days_are_read_from_one_folder_only(spark, folders):
    path, target = folders
    write_archive(day_rows(spark, T(1), T(1), T(2), "soon"), path)
    assert times(read_history(spark, path, target)) == times(read_archive(spark, path))
    compact_archive(spark, path, target, last=date(2024, 1, 1))
    assert times(read_archive(spark, target)) == ["2024-01-01"] * 2
    assert times(read_history(spark, path, target)) == ["2024-01-01", "2024-01-01", "2024-01-02", "None"]
    compact_archive(spark, path, target)
    assert set(closed_days(spark, target)) == {date(2024, 1, 1), date(2024, 1, 2), None}
    assert times(read_history(spark, path, target)) == ["2024-01-01", "2024-01-01", "2024-01-02", "None"]
    assert times(read_history(spark, path, target, date(2024, 1, 2), date(2024, 1, 3))) == ["2024-01-02"]


def test_late_events_of_closed_days_are_read_once(spark, folders):
    path, target = folders
    write_archive(day_rows(spark, T(1), T(2)), path)
    compact_archive(spark, path, target)
    write_archive(day_rows(spark, T(1), T(3), "soon"), path)
    expected = ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03", "None"]
    assert times(read_history(spark, path, target)) == expected
    assert times(read_history(spark, path, target, last=date(2024, 1, 1))) == expected[:2]
    assert set(days_to_close(spark, path, target)) == {date(2024, 1, 1), date(2024, 1, 3), None}
    compact_archive(spark, path, target)
    assert times(read_history(spark, path, target)) == expected == times(read_archive(spark, target))


def test_only_the_day_of_unreadable_times_is_closed(spark, folders):
    path, target = folders
    write_archive(day_rows(spark, "soon", "later"), path)
    compact_archive(spark, path, target)
    write_archive(day_rows(spark, "soon", T(1)), path)
    assert times(read_history(spark, path, target)) == ["2024-01-01", "None", "None", "None"]


def test_closed_days_are_skipped(spark, folders, tmp_path):
    path, target = folders
    write_archive(day_rows(spark, T(1), T(2)), path)
    compact_archive(spark, path, target)
    files = lambda: sorted(str(f) for f in (tmp_path / "closed").rglob("*.parquet"))
    before = files()
    compact_archive(spark, path, target)
    assert files() == before and days_to_close(spark, path, target) == {}


@pytest.mark.parametrize("moment", ["before the rewrite", "before the note", "folder deleted"])
def test_a_broken_off_compaction_loses_nothing(spark, folders, tmp_path, monkeypatch, moment):
    path, target = folders
    write_archive(day_rows(spark, T(1), T(2)), path)
    compact_archive(spark, path, target)
    write_archive(day_rows(spark, T(2), T(2), T(3)), path)
    expected = ["2024-01-01", *["2024-01-02"] * 3, "2024-01-03"]

    def stop(*_):
        raise KeyboardInterrupt

    real, calls = archive._note, []
    with monkeypatch.context() as broken:
        if moment == "before the rewrite":
            broken.setattr(archive, "_read_files", stop)
        else:
            broken.setattr(archive, "_note", lambda *a: stop() if calls else calls.append(real(*a)))
        with pytest.raises(KeyboardInterrupt):
            compact_archive(spark, path, target)
    if moment == "folder deleted":
        shutil.rmtree(tmp_path / "closed" / "event_date=2024-01-02")
    assert times(read_history(spark, path, target)) == expected
    assert set(closed_days(spark, target)) == {date(2024, 1, 1)}
    compact_archive(spark, path, target)
    assert times(read_history(spark, path, target)) == expected == times(read_archive(spark, target))


def test_closed_days_are_pruned_by_folder(spark, folders, capsys):
    path, target = folders
    write_archive(day_rows(spark, T(1), T(2)), path)
    compact_archive(spark, path, target, last=date(2024, 1, 1))
    plan = plan_of(read_history(spark, path, target).select("lat"), capsys)
    assert plan.count("PartitionFilters: [") == 2 and "ReadSchema: struct<lat:double>" in plan
