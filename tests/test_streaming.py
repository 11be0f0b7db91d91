import json
import threading
import time

import pytest
from pyspark.sql import functions as F
from samples import BASE

from skyledger.__main__ import run
from skyledger.config import Area, Index, Topics
from skyledger.operators.bus_records import to_bus
from skyledger.operators.letters import to_bus_or_letters
from skyledger.operators.rules import rule_alerts
from skyledger.operators.telemetry import parse_telemetry, telemetry_or_broken
from skyledger.schemas import ALERT
from skyledger.session import shared_folder
from skyledger.sources.archive import read_archive
from skyledger.sources.bus import FileBus, KafkaBus
from skyledger.streaming import jobs
from skyledger.streaming.counters import CounterTable, RunningCounts
from skyledger.streaming.publish import read_index
from skyledger.streaming.together import Together

KINDS = [{}, {"squawk": "7700"}, {"baro_altitude_ft": 70000.0}, {"ground_speed_kt": 800.0}, {"vertical_rate_fpm": -12000.0}]


def send(spark, bus, *changes, topic="flights.telemetry", first=0):
    texts = [c if isinstance(c, str) else json.dumps(BASE | c) for c in changes]
    rows = [(t, topic, i % 3, first + i) for i, t in enumerate(texts)]
    bus.write(
        spark.createDataFrame(rows, "value string, topic string, partition int, offset long").withColumn(
            "key", F.lit(None).cast("string")
        )
    )


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    bus, out = FileBus(str(tmp_path / "bus"), max_files=1), FileBus(str(tmp_path / "out"))
    checkpoint = str(tmp_path / "checkpoint")
    send(spark, bus, *KINDS, "{", json.dumps(BASE | {"stream": "x"}))
    drain(jobs.alert_by_rules(spark, bus, out, checkpoint, trigger=jobs.ONCE))

    def texts(df):
        return sorted(json.dumps(json.loads(r.value) | {"alert_generated_at": None}) for r in df.collect())

    batch = to_bus(rule_alerts(parse_telemetry(bus.read(spark, ["flights.telemetry"]))))
    assert texts(out.read(spark, ["flights.alerts"])) == texts(batch)
    assert len(texts(batch)) == 4
    # Stopped and started again, it goes on where it was.
    send(spark, bus, {"squawk": "7500"})
    for _ in range(2):
        drain(jobs.alert_by_rules(spark, bus, out, checkpoint, trigger=jobs.ONCE))
        assert out.read(spark, ["flights.alerts"]).count() == 5


def test_writers_share_a_folder(spark, tmp_path):
    bus = FileBus(str(tmp_path / "bus"))
    send(spark, bus, *KINDS)
    topics = [Topics(rule_alerts=name) for name in ("a.one", "a.two")]
    for n, own in enumerate(topics):
        drain(jobs.alert_by_rules(spark, bus, bus, str(tmp_path / f"c{n}"), own, trigger=jobs.ONCE))
    assert [bus.read(spark, [own.rule_alerts]).count() for own in topics] == [4, 4]
    # Under a new checkpoint a job sends everything again, to a folder of its own.
    drain(jobs.alert_by_rules(spark, bus, bus, str(tmp_path / "c9"), topics[0], trigger=jobs.ONCE))
    assert bus.read(spark, ["a.one"]).count() == 8
    assert bus.read(spark, ["a.three"]).count() == 0


def test_archive_stream(spark, tmp_path):
    bus = FileBus(str(tmp_path / "bus"))
    send(spark, bus, *KINDS, {"@timestamp": "2024-02-01T00:00:00Z"}, {"lat": None}, {"@timestamp": "soon"})
    for _ in range(2):
        drain(jobs.archive(spark, bus, str(tmp_path / "archive"), str(tmp_path / "checkpoint"), trigger=jobs.ONCE))
    counts = {str(r.event_date): r["count"] for r in read_archive(spark, str(tmp_path / "archive")).groupBy("event_date").count().collect()}
    assert counts == {"2024-01-15": 5, "2024-02-01": 1, "None": 1}


def test_publication_of_two_topics_with_counters(spark, tmp_path):
    bus = FileBus(str(tmp_path / "bus"))
    alert = {"alert_type": "X", "lat": 1.0, "lon": 2.0}
    send(spark, bus, alert, alert, "{", topic="flights.alerts")
    send(spark, bus, alert, topic="flights.ml-alerts")
    send(spark, bus, alert, topic="flights.other")
    counts = RunningCounts(jobs.PUBLISH_COUNTERS, every=1)
    spark.streams.addListener(counts)
    try:
        for checkpoint in ("a", "a", "b"):
            drain(jobs.publish(spark, bus, str(tmp_path / "index"), str(tmp_path / checkpoint), Index(), trigger=jobs.ONCE))
        for _ in range(50):
            if counts.totals["unreadable"] >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    docs = {r.doc_id: r["index"] for r in read_index(spark, str(tmp_path / "index")).collect()}
    assert docs == {
        "flights.alerts-0-0": "flights-alerts",
        "flights.alerts-1-1": "flights-alerts",
        "flights.ml-alerts-0-0": "flights-ml-alerts",
    }
    # The replay under the second checkpoint counts again but adds nothing.
    assert counts.totals == {"indexed": 6, "unreadable": 2}


def test_lines_of_any_number_of_aircraft_are_read_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    lines = [json.dumps({"ac": [{"hex": f"{n}-{k}", "lat": 41.9, "lon": 12.5} for k in range(n)]}) for n in (0, 1, 2, 50)]
    lines += ['{"ac": [', "{", json.dumps({"ac": None}), json.dumps({"states": [["s1"]]})]
    (landing / "poll.json").write_text("\n".join(lines))
    out = FileBus(str(tmp_path / "out"))
    query = jobs.ingest(spark, str(landing), "adsbfi", out, str(tmp_path / "checkpoint"), trigger=jobs.ONCE)
    drain(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(lines)
    metrics = [p["observedMetrics"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["ingest"]["fetched"], m["ingest"]["sent"], m["landing"]["unreadable"]) for m in metrics] == [(53, 53, 2)]
    telemetry = [json.loads(r.value)["icao24"] for r in out.read(spark, ["flights.telemetry"]).collect()]
    assert sorted(telemetry) == sorted(f"{n}-{k}" for n in (1, 2, 50) for k in range(n))
    letters = [json.loads(r.value) for r in out.read(spark, ["flights.dlq"]).collect()]
    assert sorted(d["message"] for d in letters) == ['{', '{"ac": ['] and {d["dlq_reason"] for d in letters} == {"unreadable"}
    # The vectors of the other kind of feed, and of those what is outside its area, go the same way.
    states = FileBus(str(tmp_path / "states"))
    drain(jobs.ingest(spark, str(landing), "opensky", states, str(tmp_path / "c2"), trigger=jobs.ONCE, area=Area()))
    assert states.read(spark, ["flights.telemetry"]).count() == 0 and states.read(spark, ["flights.dlq"]).count() == 2


def test_detectors_send_what_they_cannot_read_to_the_dead_letters(spark, tmp_path):
    bus, out = FileBus(str(tmp_path / "bus")), FileBus(str(tmp_path / "out"))
    send(spark, bus, {"squawk": "7700"}, "{", "", "[]", "null", json.dumps({"stream": "x"}), "{}", {"lat": "abc"})
    bus.write(spark.createDataFrame([(None, None, "flights.telemetry", 0, 99)], "key string, value string, topic string, partition int, offset long"))
    query = jobs.alert_by_rules(spark, bus, out, str(tmp_path / "checkpoint"), trigger=jobs.ONCE)
    drain(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 9
    assert sum(p["observedMetrics"]["rules"]["unreadable"] for p in query.recentProgress if p["numInputRows"]) == 5
    assert [json.loads(r.value)["icao24"] for r in out.read(spark, ["flights.alerts"]).collect()] == ["abc123"]
    letters = [json.loads(r.value) for r in out.read(spark, ["flights.dlq"]).collect()]
    assert sorted(d["message"] for d in letters) == ["", "", "[]", "null", "{"]
    assert {(d["dlq_reason"], d["detector"]) for d in letters} == {("unreadable", "spark_rules")}


def test_one_parse_serves_alerts_and_letters(spark, tmp_path, capsys):
    bus = FileBus(str(tmp_path / "bus"))
    send(spark, bus, {"squawk": "7700"}, "{")
    alerts = rule_alerts(telemetry_or_broken(bus.read(spark, ["flights.telemetry"])))
    capsys.readouterr()
    to_bus_or_letters(alerts, ALERT.names, F.lit("flights.alerts")).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1 and plan.count("FileScan") == 1 and "Exchange" not in plan


def wait_for(condition):
    for _ in range(300):
        if condition():
            return
        time.sleep(0.1)
    raise AssertionError("it did not happen in time")


def test_the_fall_of_one_job_leaves_the_others(spark, tmp_path):
    bus, out = FileBus(str(tmp_path / "bus")), FileBus(str(tmp_path / "out"))
    send(spark, bus, *KINDS)
    archived = lambda: read_archive(spark, str(tmp_path / "archive")).count() if (tmp_path / "archive").exists() else 0
    alerts = lambda: out.read(spark, ["flights.alerts"]).count()

    def falling():
        def fail(batch, batch_id):
            raise RuntimeError("on purpose")

        writer = bus.read_stream(spark, ["flights.telemetry"]).writeStream.foreachBatch(fail)
        return jobs.launch(writer, "falling", str(tmp_path / "c-falling"))

    starts = {
        "archive": lambda: jobs.archive(spark, bus, str(tmp_path / "archive"), str(tmp_path / "c-archive")),
        "falling": falling,
        "rules": lambda: jobs.alert_by_rules(spark, bus, out, str(tmp_path / "c-rules")),
    }
    together = Together(spark, starts, restarts=1).start()
    waiting = threading.Thread(target=together.wait)
    try:
        waiting.start()
        wait_for(lambda: len(together.fallen.get("falling", [])) == 2)
        assert together.running() == ["archive", "rules"] and list(together.fallen) == ["falling"]
        # What comes after the fall is worked on as before.
        send(spark, bus, *KINDS, first=10)
        wait_for(lambda: archived() == 10 and alerts() == 8)
        # Stopping one is no fall, and leaves the other.
        together.queries["archive"].stop()
        send(spark, bus, *KINDS, first=20)
        wait_for(lambda: alerts() == 12)
        assert archived() == 10 and together.running() == ["rules"] and waiting.is_alive()
    finally:
        together.stop()
        waiting.join(60)
    assert not waiting.is_alive() and list(together.fallen) == ["falling"]


def test_jobs_named_together(spark, tmp_path):
    bus = FileBus(str(tmp_path / "bus"))
    send(spark, bus, *KINDS)
    env = {
        "JOBS": "rules, archive",
        "BUS_PATH": str(tmp_path / "bus"),
        "BUS_OUT_PATH": str(tmp_path / "out"),
        "PARQUET_PATH": str(tmp_path / "archive"),
        "CHECKPOINT_DIR": str(tmp_path / "checkpoints"),
    }
    run("together", spark, env, trigger=jobs.ONCE)
    assert read_archive(spark, str(tmp_path / "archive")).count() == 5
    assert FileBus(str(tmp_path / "out")).read(spark, ["flights.alerts"]).count() == 4
    assert {f.name for f in (tmp_path / "checkpoints").iterdir()} == {"rules", "archive"}
    with pytest.raises(SystemExit):
        run("together", spark, env | {"JOBS": "rules,unknown"}, trigger=jobs.ONCE)


def test_a_folder_bus_is_read_from_where_the_first_start_said(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "bus"), str(tmp_path / "checkpoint")
    latest, earliest = FileBus(folder, starting_offsets="latest"), FileBus(folder)
    out = FileBus(str(tmp_path / "out"))
    alerts = lambda: out.read(spark, ["flights.alerts"]).count()
    send(spark, latest, *KINDS)
    drain(jobs.alert_by_rules(spark, latest, out, checkpoint, trigger=jobs.ONCE))
    assert alerts() == 0
    # Asked for the earliest record now, it goes on as it began, and a lost checkpoint does not lose the mark.
    send(spark, latest, *KINDS, first=10)
    for bus in (earliest, latest):
        drain(jobs.alert_by_rules(spark, bus, out, checkpoint, trigger=jobs.ONCE))
        assert alerts() == 4
    # One that began at the earliest record takes everything, whatever it is asked for later.
    other = FileBus(str(tmp_path / "other"))
    for bus in (earliest, latest):
        drain(jobs.alert_by_rules(spark, bus, other, str(tmp_path / "c2"), trigger=jobs.ONCE))
        assert other.read(spark, ["flights.alerts"]).count() == 8
    with pytest.raises(ValueError, match="checkpoint"):
        latest.read_stream(spark, ["flights.telemetry"])
    with pytest.raises(ValueError, match="earliest or latest"):
        FileBus(folder, starting_offsets="5").read_stream(spark, ["flights.telemetry"], checkpoint)


def test_repeated_batches_count_once(spark, tmp_path):
    table = CounterTable(spark, str(tmp_path / "counters"))
    assert table.totals("a") == {}
    for batch in (0, 1, 1, 2, 3, 3, 3):
        table.put("a", "q", batch, {"n": 10 + batch, "m": 1})
    assert table.totals("a") == {"n": 46, "m": 4}
    # Another memory of the job, and another counter.
    table.put("a", "r", 0, {"n": 5})
    table.put("b", "q", 7, {"n": 1})
    assert CounterTable(spark, str(tmp_path / "counters")).totals("a") == {"n": 51, "m": 4}
    assert [tuple(r) for r in table.frame(["a", "b"]).collect()] == [("a", "m", 4), ("a", "n", 51), ("b", "n", 1)]
    assert len(list((tmp_path / "counters" / "counter=a" / "query=q").glob("*.json"))) <= 3
    assert RunningCounts("a", table=table).totals == {"n": 51, "m": 4}


def test_jobs_from_landing_to_index(spark, tmp_path):
    """The whole way, each job started as the command line would."""
    landing = tmp_path / "landing"
    landing.mkdir()
    craft = [
        {"hex": "a1", "lat": 41.9, "lon": 12.5, "squawk": "7700"},
        {"hex": "a2", "lat": 41.9, "lon": 12.5, "alt_baro": 30000},
        {"hex": "a3"},
        {"hex": " "},
    ]
    (landing / "poll.json").write_text(json.dumps({"aircraft": craft}) + "\n")
    env = {
        "LANDING_PATH": str(landing),
        "BUS_PATH": str(tmp_path / "telemetry"),
        "PARQUET_PATH": str(tmp_path / "archive"),
        "INDEX_PATH": str(tmp_path / "copies"),
    }

    def start(job, **more):
        run(job, spark, env | {"CHECKPOINT_DIR": str(tmp_path / f"checkpoint-{job}")} | more, trigger=jobs.ONCE)

    start("ingest", BUS_OUT_PATH=env["BUS_PATH"])
    start("index")
    start("archive")
    start("rules", BUS_OUT_PATH=str(tmp_path / "alerts"))
    out = spark.read.parquet(env["BUS_PATH"]).groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in out} == {"flights.telemetry": 2, "flights.dlq": 1}
    copies = spark.read.parquet(env["INDEX_PATH"]).groupBy("index").count().collect()
    assert {r["index"]: r["count"] for r in copies} == {"flights-telemetry": 2, "flights-dlq": 1}
    assert read_archive(spark, env["PARQUET_PATH"]).count() == 2
    alerts = FileBus(str(tmp_path / "alerts")).read(spark, ["flights.alerts"]).collect()
    assert [json.loads(a.value)["icao24"] for a in alerts] == ["a1"]
    # A single class is reported by the exit code.
    with pytest.raises(SystemExit) as exit_:
        run("train", spark, env | {"PARQUET_PATH": env["PARQUET_PATH"], "MODEL_OUT": str(tmp_path / "model")})
    assert exit_.value.code == 2
    with pytest.raises(SystemExit):
        start("unknown")


def test_kafka_options():
    bus = KafkaBus("broker:9092", "earliest", min_partitions=64)
    assert bus._options(["a", "b"]) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "a,b",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }
    safe = KafkaBus("b:1", acks="all", compression="lz4", options={"security.protocol": "SSL"})
    assert safe._producer() == {
        "kafka.bootstrap.servers": "b:1",
        "kafka.security.protocol": "SSL",
        "kafka.acks": "all",
        "kafka.compression.type": "lz4",
    }


class _Session:
    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}


def test_a_cluster_must_name_its_shared_folder():
    assert shared_folder(_Session("spark://x", "hdfs://y/z/")) == "hdfs://y/z"
    assert shared_folder(_Session("local[2]", None))
    with pytest.raises(RuntimeError):
        shared_folder(_Session("spark://x", None))
