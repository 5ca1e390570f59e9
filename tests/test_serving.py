"""Catalog, health and experiment answers over a store that the jobs have written."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import event

from fleetscope.cli import main
from fleetscope.plans import experiment as X
from fleetscope.plans import serving as S
from fleetscope.plans.gate import run_aggregation
from fleetscope.streaming.processor import TelemetryProcessor


def batch(spark, texts):
    return spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary")


def day(n, tag, hours=range(24)):
    return [event(event_id=f"{tag}{h}", value=float(h), timestamp=f"2026-04-{n:02d}T{h:02d}:{h:02d}:00Z") for h in hours]


@pytest.fixture()
def store_root(spark, tmp_root):
    proc = TelemetryProcessor(tmp_root)
    proc.process_batch(batch(spark, day(1, "a") + day(2, "b") + ["broken"]), 0)
    run_aggregation(spark, tmp_root)
    proc.process_batch(batch(spark, day(1, "c", range(0, 24, 2))), 1)   # day 1 again
    run_aggregation(spark, tmp_root)
    proc.process_batch(batch(spark, day(1, "d", range(0, 24, 3))), 2)   # and again
    run_aggregation(spark, tmp_root)
    return tmp_root


def test_row_counts_after_two_rewrites_of_a_day(spark, store_root):
    got = {r["table_name"]: r for r in S.tables(spark, store_root).collect()}
    assert got["hourly_aggregates"]["row_count"] == 48 and got["hourly_aggregates"]["snapshot_count"] == 3
    assert got["clean_events"]["row_count"] == 48 + 12 + 8 and got["dead_letter"]["row_count"] == 1
    assert S.totals(spark, store_root).first()["total_rows"] == 48 + 68 + 1
    assert {r["band"] for r in S.bands(spark, store_root).collect()} == {"green", "N/A"}


def test_detail_snapshots_and_samples(spark, store_root):
    assert S.table_detail(spark, store_root, "dead_letter").count() == 4
    assert sorted(r["snapshot_id"] for r in S.snapshots(spark, store_root, "clean_events").collect()) == ["1", "2", "3"]
    first = S.sample(spark, store_root, "clean_events", snapshot_id=1, limit=100).collect()
    assert len(first) == 48 and {r["event_id"][0] for r in first} == {"a", "b"}
    for call in (S.table_detail, S.snapshots, S.sample):
        with pytest.raises(KeyError):
            call(spark, store_root, "nope")


def test_freshness_follows_the_clock(spark, store_root):
    now = F.current_timestamp()
    assert S.storage_status(spark, store_root, now).first()["status"] == "healthy"
    later = now + F.expr("INTERVAL 2 HOURS")
    assert S.storage_status(spark, store_root, later).first()["status"] == "degraded"


def test_an_empty_store(spark, tmp_root):
    got = {r["table_name"]: r["row_count"] for r in S.tables(spark, tmp_root).collect()}
    assert got == {"clean_events": 0, "dead_letter": 0, "hourly_aggregates": 0}
    assert S.experiments(spark, tmp_root).collect() == []
    with pytest.raises(KeyError):
        S.latest_model(spark, tmp_root)
    with pytest.raises(KeyError):
        S.experiment(spark, tmp_root, "exp_none")


def test_train_on_the_first_snapshot_then_evaluate_it(spark, store_root, tmp_root):
    root = "file://" + os.path.join(tmp_root, "experiments")     # a URI, as on a cluster
    exp = X.run_training(spark, store_root, root, epochs=2, patience=1, snapshot_id=1, evaluate_after=False)
    listed = S.experiments(spark, root).collect()
    assert [r["experiment_id"] for r in listed] == [exp] and listed[0]["precision"] is None
    report = X.run_evaluation(spark, store_root, root).first()
    sizes = S.experiment(spark, root, exp).first()["dataset"]
    assert sizes["snapshot_id"] == "1" and sizes["train_size"] + sizes["val_size"] + sizes["test_size"] == 48
    assert report["dataset"]["train_size"] == sizes["train_size"]
    assert S.experiments(spark, root).first()["precision"] is not None
    model = S.latest_model(spark, root).first()
    assert spark.read.parquet(model["model_path"]).count() == 1
    assert S.loss_curve(spark, root, exp).count() == 2


def test_going_back_behind_the_hourly_table_is_refused(spark, store_root):
    with pytest.raises(ValueError):
        run_aggregation(spark, store_root, as_of=1)


def test_commands(spark, store_root, capsys):
    lines = lambda: [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert main(["catalog", "--store", store_root]) == 0
    assert {r["table_name"]: r["row_count"] for r in lines()}["hourly_aggregates"] == 48
    assert main(["catalog", "--store", store_root, "--table", "clean_events", "--sample", "--limit", "3"]) == 0
    assert len(lines()) == 3
    assert main(["catalog", "--store", store_root, "--table", "clean_events", "--snapshots"]) == 0
    assert [r["snapshot_id"] for r in lines()] == ["1", "2", "3"]
    assert main(["catalog", "--store", store_root, "--table", "nope"]) == 1
    assert main(["health", "--store", store_root]) == 0
    assert main(["health", "--store", store_root, "--as-of", "2199-01-01T00:00:00Z"]) == 1
    assert main(["experiments", "--experiments", store_root + "/none"]) == 0
    assert main(["experiments", "--experiments", store_root + "/none", "--latest"]) == 1


class Recorder:
    """Stands in for a reader or writer: keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def load(self):
        return self.told

    def save(self):
        return self.told

    start = save


class Session:
    def __init__(self):
        self.read = self.readStream = Recorder()


def test_kafka_readers_are_told_the_topic():
    from fleetscope.sources import messages
    told = messages.stream_source(Session(), "host:9092", "t", maxOffsetsPerTrigger="5")
    assert told == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t",
                    "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"}
    told = messages.replay_source(Session(), "host:9092", "t")
    assert told == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t",
                    "startingOffsets": "earliest", "endingOffsets": "latest"}


def test_kafka_writers_are_told_the_topic(monkeypatch):
    from fleetscope.sources import messages
    made = []

    class Events:
        @property
        def write(self):
            made.append(Recorder())
            return made[-1]
        writeStream = write
    monkeypatch.setattr(messages, "encode_events", lambda events, key=None: events)
    messages.write_messages(Events(), "h:1", "t")
    assert made[-1].told == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "topic": "t"}
    told = messages.stream_messages(Events(), "h:1", "t", "/c")
    assert told == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "topic": "t", "checkpointLocation": "/c"}


def test_cli_streams_and_replays_a_topic(spark, tmp_root, monkeypatch, capsys):
    """The commands reach the Kafka reader; a text source stands in for the broker."""
    from fleetscope.sources import messages, store
    src = os.path.join(tmp_root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write(event(event_id="k1") + "\n" + event(event_id="k2", value=5000) + "\n")
    asked = []

    def stream(s, servers, topic):
        asked.append((servers, topic))
        return messages.text_stream_source(s, src)

    def replay(s, servers, topic):
        asked.append((servers, topic))
        return s.read.text(src).select(F.col("value").cast("binary").alias("value"), F.lit(0).alias("offset"))
    monkeypatch.setattr(messages, "stream_source", stream)
    monkeypatch.setattr(messages, "replay_source", replay)
    root = os.path.join(tmp_root, "store")
    assert main(["stream", "--servers", "h:9", "--topic", "tt", "--store", root, "--checkpoint",
                 os.path.join(tmp_root, "ck"), "--once"]) == 0
    assert store.read_snapshots(spark, root, "clean_events").count() == 2
    assert main(["replay", "--servers", "h:9"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["anomalies"] == 1
    assert asked == [("h:9", "tt"), ("h:9", "telemetry.raw")]
