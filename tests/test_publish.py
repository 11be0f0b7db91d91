import json

import pytest
from pyspark.sql import functions as F
from samples import BASE

from skyledger.operators.documents import BLOCK, alert_documents, index_name, unmapped
from skyledger.schemas import ALERT_DOCUMENT
from skyledger.streaming import publish
from skyledger.streaming.publish import ensure_index, publish_batch, read_index

ALERT = {
    "@timestamp": BASE["@timestamp"],
    "alert_generated_at": BASE["@timestamp"],
    "event_type": "flight_alert",
    "detector": "spark_rules",
    "alert_type": "ALT_OUTLIER",
    "severity": 4,
    "icao24": "abc123",
    "lat": 41.9,
    "lon": 12.5,
    "raw": {"baro_altitude_ft": 70000.0},
}


def records(spark, *places, alert=ALERT):
    text = json.dumps(alert)
    rows = [(text, topic, partition, offset) for topic, partition, offset in places]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")


def ids(spark, path):
    return sorted(r.doc_id for r in read_index(spark, path).collect())


def test_index_names(spark):
    df = spark.createDataFrame([("flights.alerts",), ("flights.ml-alerts",), ("a.b.c",), ("plain",), (".x",), ("y.",)], "t string")
    names = [r[0] for r in df.select(index_name(F.col("t"), "p")).collect()]
    assert names == ["p-alerts", "p-ml-alerts", "p-b.c", "p-plain", "p-x", "p-"]


def test_document(spark):
    doc = alert_documents(records(spark, ("flights.alerts", 2, 41)), "flights").first()
    assert (doc.doc_id, doc["index"], doc.severity) == ("flights.alerts-2-41", "flights-alerts", 4)
    assert (doc.location.lat, doc.location.lon, doc.raw.baro_altitude_ft) == (41.9, 12.5, 70000.0)
    assert doc["@timestamp"].isoformat() == "2024-01-15T10:20:30"
    assert alert_documents(records(spark, ("t", 0, 0), alert=ALERT | {"lat": None})).first().location is None


def test_unreadable_records_are_left_out(spark):
    good = records(spark, ("t", 0, 0))
    for text in ("{", None):
        bad = good.withColumn("value", F.lit(text).cast("string")).withColumn("offset", F.lit(1).cast("long"))
        assert [d.offset for d in alert_documents(good.union(bad)).collect()] == [0]


@pytest.fixture
def path(spark, tmp_path):
    target = str(tmp_path / "index")
    ensure_index(spark, target)
    return target


def put(spark, path, batch_id, *places):
    publish_batch(alert_documents(records(spark, *places)), batch_id, path)


def test_table_is_typed_before_it_has_rows(spark, path):
    assert read_index(spark, path).count() == 0
    assert read_index(spark, path).schema.simpleString() == ALERT_DOCUMENT.simpleString()
    put(spark, path, 0, ("t.a", 0, 1))
    ensure_index(spark, path)
    assert ids(spark, path) == ["t.a-0-1"]


def test_replays_do_not_duplicate(spark, path):
    batch = [("t.a", p, o) for p in range(3) for o in range(5)]
    put(spark, path, 0, *batch)
    put(spark, path, 0, *batch)
    # Another checkpoint cuts its batches elsewhere and counts them anew.
    put(spark, path, 0, *batch[:4], ("t.b", 0, 0))
    put(spark, path, 1, *batch[2:], ("t.a", 0, 5), ("t.a", 0, 5))
    assert ids(spark, path) == sorted(f"{t}-{p}-{o}" for t, p, o in [*batch, ("t.b", 0, 0), ("t.a", 0, 5)])


def test_a_half_written_batch_is_completed(spark, path):
    batch = [("t.a", 0, o) for o in range(10)]
    put(spark, path, 7, *batch[3:6])
    put(spark, path, 7, *batch)
    assert len(ids(spark, path)) == 10


def test_offsets_in_many_blocks(spark, path):
    batch = [("t.a", 0, b * BLOCK + 1) for b in (0, 1, 5)]
    put(spark, path, 0, *batch)
    put(spark, path, 1, ("t.a", 0, BLOCK + 1), ("t.a", 0, 3 * BLOCK), ("t.c", 0, 9 * BLOCK))
    assert len(ids(spark, path)) == 5


def test_only_touched_blocks_are_opened(spark, path):
    far = 5000
    put(spark, path, 0, *[("t.a", 0, b * BLOCK) for b in range(4)], ("t.b", 0, far * BLOCK), ("t.b", 0, 0))
    touched = [{"index": "flights-a", "offset_block": b} for b in (1, 2, 9)] + [{"index": "flights-b", "offset_block": far}]
    known = publish._known_ids(spark, path, touched)
    assert {f.split("/index=")[1].rsplit("/", 1)[0] for f in known.inputFiles()} == {
        "flights-a/offset_block=1",
        "flights-a/offset_block=2",
        f"flights-b/offset_block={far}",
    }
    assert known.count() == 3
    assert publish._known_ids(spark, path, [{"index": "flights-none", "offset_block": 0}]) is None


def test_odd_fields_are_null_and_the_text_stays(spark):
    odd = ALERT | {"lat": "abc", "severity": 4.5, "@timestamp": "soon", "extra": [1]}
    doc = alert_documents(records(spark, ("t", 0, 0), alert=odd)).first()
    assert (doc.lat, doc.severity, doc["@timestamp"], doc.location) == (None, None, None, None)
    assert (doc.alert_type, doc.raw.baro_altitude_ft) == ("ALT_OUTLIER", 70000.0)
    assert doc.document.toPython()["extra"] == [1]
    twice = records(spark, ("t", 0, 0)).withColumn("value", F.lit('{"icao24": "a", "x": 1, "x": 2}'))
    assert alert_documents(twice).first().document.toPython() == '{"icao24": "a", "x": 1, "x": 2}'
    for text in ("5", "[]", "null", '{"a": '):
        assert alert_documents(records(spark, ("t", 0, 0)).withColumn("value", F.lit(text))).count() == 0


def test_records_without_offset_are_named_after_their_row(spark):
    plain = records(spark, ("t.a", None, None), ("t.a", None, None))
    with pytest.raises(Exception, match="cannot be told"):
        alert_documents(plain).collect()
    named = plain.withColumn("record_id", F.concat(F.lit("f-"), F.monotonically_increasing_id())).withColumn("record_day", F.lit(20240115).cast("long"))
    docs = alert_documents(named).collect()
    assert len({d.doc_id for d in docs}) == 2 and {d.offset_block for d in docs} == {-20240115}


def test_an_empty_batch_writes_nothing(spark, path):
    publish_batch(alert_documents(records(spark, ("t.a", 0, 0))).filter("false"), 0, path)
    assert ids(spark, path) == []


def at(spark, *rows):
    """Records of topic t.a, partition 0: offset, reason, time on the bus."""
    texts = [(json.dumps(ALERT | {"reason": reason}), "t.a", 0, offset, time) for offset, reason, time in rows]
    records = spark.createDataFrame(texts, "value string, topic string, partition int, offset long, time string")
    return alert_documents(records.withColumn("timestamp", F.col("time").cast("timestamp")))


def reasons(spark, path):
    rows = read_index(spark, path).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.offset: r.reason for r in rows}


def test_the_newest_version_stays(spark, path):
    day = "2024-03-0{}".format
    publish_batch(at(spark, (0, "a", day(2)), (1, "a", day(2)), (2, "a", day(2)), (3, "a", None), (4, "a", None)), 0, path)
    publish_batch(at(spark, (0, "b", day(3)), (1, "b", day(1)), (2, "b", day(2)), (3, "b", None), (4, "b", day(1)), (5, "b", None)), 1, path)
    expected = {0: "b", 1: "a", 2: "b", 3: "b", 4: "b", 5: "b"}
    assert reasons(spark, path) == expected
    # Versions of several times in one batch, and one without a time after one that has it.
    publish_batch(at(spark, (0, "c", None), (0, "d", day(4)), (0, "e", day(3)), (6, "c", day(1)), (6, "d", day(2))), 2, path)
    assert reasons(spark, path) == expected | {0: "d", 6: "d"}


def test_unmapped_fields_are_read_from_the_table(spark, path):
    for offset, extra in enumerate([{"a": {"b": [1, {"c": "x"}]}}, {"a": 7}, {"a": None}, {}]):
        publish_batch(alert_documents(records(spark, ("t.a", 0, offset), alert=ALERT | extra)), offset, path)
    found = read_index(spark, path).select("offset", unmapped("$.a.b[1].c", "string").alias("c"), unmapped("$.a", "int").alias("a"))
    assert sorted(tuple(r) for r in found.collect()) == [(0, "x", None), (1, None, 7), (2, None, None), (3, None, None)]
    # A correction replaces them with the rest.
    corrected = records(spark, ("t.a", 0, 1), alert=ALERT | {"a": 8}).withColumn("timestamp", F.lit("2024-03-01").cast("timestamp"))
    publish_batch(alert_documents(corrected), 9, path)
    assert read_index(spark, path).filter("offset = 1").select(unmapped("$.a", "int")).first()[0] == 8


def test_other_folders_are_left_alone(spark, path, tmp_path):
    publish_batch(at(spark, *[(b * BLOCK, "a", None) for b in range(3)]), 0, path)
    files = lambda b: {f.name for f in (tmp_path / "index" / "index=flights-a" / f"offset_block={b}").glob("*.parquet")}
    before = [files(b) for b in range(3)]
    publish_batch(at(spark, (BLOCK, "b", None), (0, "a", None), (1, "new", None)), 1, path)
    after = [files(b) for b in range(3)]
    assert before[0] < after[0] and not before[1] & after[1] and before[2] == after[2]
    assert reasons(spark, path) == {0: "a", 1: "new", BLOCK: "b", 2 * BLOCK: "a"}


BATCHES = [[(k, "a", None) for k in range(6)], [(k, "b", None) for k in range(0, 8, 2)]]
MERGED = {0: "b", 1: "a", 2: "b", 3: "a", 4: "b", 5: "a", 6: "b"}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("moment", ["before the mark", "before the replacement", "after the deletion"])
def test_a_broken_off_replacement_is_finished(spark, path, tmp_path, monkeypatch, moment):
    publish_batch(at(spark, *BATCHES[0]), 0, path)

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as broken:
        if moment == "before the mark":
            broken.setattr(publish, "create_file", stop)
        else:
            real, calls = publish.finish_replacement, []
            broken.setattr(publish, "finish_replacement", lambda *a: stop() if calls else calls.append(real(*a)))
        with pytest.raises(Stopped):
            publish_batch(at(spark, *BATCHES[1]), 1, path)
    if moment == "after the deletion":
        publish.remove_path(spark, str(tmp_path / "index" / "index=flights-a" / "offset_block=0"))
    # Retried, or followed by a batch that has nothing to do with it.
    publish_batch(at(spark, *BATCHES[1] if moment == "before the mark" else [(9 * BLOCK, "x", None)]), 1, path)
    assert reasons(spark, path) == MERGED | ({} if moment == "before the mark" else {9 * BLOCK: "x"})
    publish_batch(at(spark, *BATCHES[1]), 1, path)
    assert {k: v for k, v in reasons(spark, path).items() if k < BLOCK} == MERGED
    assert not [f for f in (tmp_path / "index").iterdir() if f.name.startswith("_pending")]


def test_tables_of_an_earlier_layout_are_read(spark, tmp_path):
    path = str(tmp_path / "old")
    old = at(spark, (0, "a", None), (1, "a", None)).drop("version", "fingerprint")
    old.write.partitionBy("index", "offset_block").parquet(path)
    publish_batch(at(spark, (1, "b", "2024-03-01"), (2, "b", None)), 0, path)
    assert reasons(spark, path) == {0: "a", 1: "b", 2: "b"}


def test_a_hot_id_is_reduced_before_it_moves(spark, capsys):
    publish.newest_versions(at(spark, (0, "a", None))).explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")


def test_what_the_table_holds_does_not_go_by_way_of_the_driver(spark, path, capsys):
    put(spark, path, 0, ("t.a", 0, 1))
    known = publish._known_ids(spark, path, [{"index": "flights-a", "offset_block": 0}])
    publish.compared(at(spark, (1, "b", None)), known).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_documents_that_are_held_already_do_not_move(spark, path, monkeypatch):
    moved = []
    real = publish.newest_versions
    monkeypatch.setattr(publish, "newest_versions", lambda rows: moved.append(rows.columns) or real(rows))
    monkeypatch.setattr(publish, "_laid_out", lambda rows, write=publish._laid_out: moved.append(rows.columns) or write(rows))
    batch = [(0, "a", None), (1, "a", None)]
    publish_batch(at(spark, *batch), 0, path)
    del moved[:]
    publish_batch(at(spark, *batch), 1, path)
    assert moved == [["doc_id", "version", "fingerprint", "index", "offset_block"]]
    assert reasons(spark, path) == {0: "a", 1: "a"}


def test_copies_in_a_batch_of_new_corrected_and_held_documents(spark, path):
    publish_batch(at(spark, (0, "a", None), (1, "a", None), (1, "a", None), (2, "a", None)), 0, path)
    publish_batch(at(spark, (0, "a", None), (1, "b", None), (1, "b", None), (3, "c", None), (3, "c", None)), 1, path)
    assert reasons(spark, path) == {0: "a", 1: "b", 2: "a", 3: "c"}
