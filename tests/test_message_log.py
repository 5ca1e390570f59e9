"""S1, S2, S9, H3 and T4 over the message log: offsets, restart, lag, history, one commit."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import event

from fleetscope.operators import health as H
from fleetscope.plans import serving
from fleetscope.sources import messagelog as ML
from fleetscope.sources import store
from fleetscope.streaming.history import ingest_history
from fleetscope.streaming.processor import TelemetryProcessor


def published(spark, path, texts, topic="t", partitions=3, **columns):
    rows = [(i, bytearray(t.encode())) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n long, value binary").repartition(3).sortWithinPartitions("n")
    ML.write_log(df.withColumn("partition", (F.col("n") % partitions).cast("int")), path, topic)


def values(df):
    return sorted((r.partition, r.offset, bytes(r.value).decode()) for r in df.collect())


def test_replay_from_offset_to_offset(spark, tmp_root):
    published(spark, tmp_root, [f"a{i}" for i in range(30)])
    published(spark, tmp_root, [f"b{i}" for i in range(9)])
    every = values(ML.log_replay(spark, tmp_root, "t"))
    assert len(every) == 39 and [(p, o) for p, o, _ in every] == [(p, o) for p in range(3) for o in range(13)]
    assert {v for _, _, v in every} == {f"a{i}" for i in range(30)} | {f"b{i}" for i in range(9)}
    assert values(ML.log_replay(spark, tmp_root, "t", rowsPerTask=4)) == every
    assert ML.log_replay(spark, tmp_root, "t", rowsPerTask=4).rdd.getNumPartitions() == 12
    start, end = json.dumps({"t": {"0": 5, "2": -2}}), json.dumps({"t": {"0": 12, "2": -1}})
    assert values(ML.log_replay(spark, tmp_root, "t", start, end)) == [
        x for x in every if (x[0] == 0 and 5 <= x[1] < 12) or x[0] == 2]
    with pytest.raises(Exception, match="not all in the log"):
        ML.log_replay(spark, tmp_root, "t", ending_offsets=json.dumps({"t": {"0": 99}})).collect()
    assert ML.log_replay(spark, tmp_root, "no such topic").collect() == []


def test_a_key_stays_in_its_partition_and_failed_jobs_publish_nothing(spark, tmp_root):
    df = spark.range(200).select((F.col("id") % 5).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    ML.write_log(df.repartition(4), tmp_root, "keyed", partitions=4)
    got = ML.log_replay(spark, tmp_root, "keyed")
    assert got.count() == 200 and got.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    before = ML.Topic(tmp_root, "keyed").heads()
    bad = df.repartition(4).withColumn("value", F.when(F.col("value") == "77", F.raise_error(F.lit("no"))).otherwise(F.col("value")))
    with pytest.raises(Exception):
        ML.write_log(bad, tmp_root, "keyed")
    assert ML.Topic(tmp_root, "keyed").heads() == before


def test_a_restarted_stream_goes_on_at_its_offsets(spark, tmp_root):
    log, root, ck = (os.path.join(tmp_root, x) for x in ("log", "store", "ck"))
    published(spark, log, [event(event_id=f"a{i}") for i in range(20)] + ["not json"])
    seen = []
    for batch in ([], [event(event_id=f"b{i}", value=-1.0) for i in range(4)]):
        if batch:
            published(spark, log, batch)
        proc = TelemetryProcessor(root)
        q = proc.start(ML.log_stream(spark, log, "t"), ck, available_now=True)
        q.awaitTermination()
        seen.append(proc.last_counts)
    assert seen == [{0: (20, 1)}, {1: (0, 4)}]
    assert store.read_snapshots(spark, root, "clean_events").count() == 20
    assert store.read_snapshots(spark, root, "dead_letter").count() == 5


def test_lag_by_partition_and_ingest_history(spark, tmp_root):
    import time
    log, root, ck = (os.path.join(tmp_root, x) for x in ("log", "store", "ck"))
    published(spark, log, [event(event_id=f"a{i}") for i in range(30)] + [event(device_id="device_999", value=-2)])
    proc = TelemetryProcessor(root)
    q = proc.start(ML.log_stream(spark, log, "t"), ck, available_now=True, history=True)
    q.awaitTermination()
    lag = H.lag_from_progress(spark, q.lastProgress).orderBy("partition").collect()
    assert [(r.partition, r.latest_offset, r.lag) for r in lag] == [(0, 10, 0), (1, 9, 0), (2, 9, 0)]
    # more arrives while no stream runs: the heads move on, the committed offsets do not
    published(spark, log, [event(event_id=f"b{i}") for i in range(7)])
    progress = {"sources": [{"endOffset": q.lastProgress["sources"][0]["endOffset"],
                             "latestOffset": {"t": ML.Topic(log, "t").heads()}}]}
    assert [(r.partition, r.lag) for r in H.lag_from_progress(spark, progress).orderBy("partition").collect()] == [(0, 3), (1, 2), (2, 2)]
    q = proc.start(ML.log_stream(spark, log, "t"), ck, available_now=True)
    q.awaitTermination()
    deadline = time.time() + 60
    while time.time() < deadline and ingest_history(spark, root).count() < 2:
        time.sleep(0.5)  # progress events arrive on a thread of their own
    rows = ingest_history(spark, root).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.valid, r.rejected) for r in rows] == [(0, 31, 30, 1), (1, 7, 7, 0)]
    assert rows[0].rules == {"timestamp": 0, "device": 1, "value": 1, "metric": 0}
    health = serving.past_ingest_health(spark, root, "t").first()
    assert (health.partitions, health.total_lag, health.status) == (3, 0, "healthy")
    assert serving.past_ingest_health(spark, root, "other").first().status == "unhealthy"
    total = serving.ingest_totals(spark, root).first()
    assert (total.valid, total.rejected, total.rules["device"]) == (37, 1, 1)
    assert serving.ingest_totals(spark, tmp_root + "/none").collect() == []


def test_cli_streams_replays_and_reports_a_log(spark, tmp_root, capsys):
    from fleetscope.cli import main
    log, root = os.path.join(tmp_root, "log"), os.path.join(tmp_root, "store")
    published(spark, log, [event(event_id="a"), event(event_id="b", value=5000), "bad"], topic="telemetry.raw")
    assert main(["stream", "--log", log, "--store", root, "--checkpoint", os.path.join(tmp_root, "ck"), "--once", "--history"]) == 0
    assert store.read_snapshots(spark, root, "clean_events").count() == 2
    assert main(["replay", "--log", log]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["anomalies"] == 2
    import time
    deadline = time.time() + 60
    while time.time() < deadline and not ingest_history(spark, root).count():
        time.sleep(0.5)
    assert main(["ingest", "--store", root]) == 0
    totals, health = (json.loads(x) for x in capsys.readouterr().out.strip().splitlines()[-2:])
    assert int(totals["valid"]) == 2 and int(totals["rejected"]) == 1 and health["status"] == "healthy"


class Stop(Exception):
    pass


def test_clean_events_and_dead_letters_are_seen_together(spark, tmp_root, monkeypatch):
    msgs = lambda *t: spark.createDataFrame([(bytearray(x.encode()),) for x in t], "value binary")
    counts = lambda: tuple(store.read_snapshots(spark, tmp_root, t).count() for t in store.BATCH_TABLES)
    proc = TelemetryProcessor(tmp_root)
    proc.process_batch(msgs(event(event_id="a"), "bad"), 0)
    assert counts() == (1, 1)
    write = store._write

    def stops(df, root, table, snapshot):
        if table == "dead_letter":
            raise Stop
        return write(df, root, table, snapshot)
    monkeypatch.setattr(store, "_write", stops)
    with pytest.raises(Stop):
        proc.process_batch(msgs(event(event_id="b"), "bad"), 1)
    assert counts() == (1, 1)          # the clean side is on disk, and not seen
    monkeypatch.setattr(store, "_write", write)
    monkeypatch.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        proc.process_batch(msgs(event(event_id="b"), "bad"), 1)
    assert counts() == (1, 1)          # both sides are on disk, and not seen
    monkeypatch.undo()
    for again in (proc, TelemetryProcessor(tmp_root)):   # the replay, and the replay of a committed batch
        again.process_batch(msgs(event(event_id="b"), "bad"), 1)
        assert counts() == (2, 2)
    # a side that has become empty replaces what an unfinished attempt has left
    monkeypatch.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        proc.process_batch(msgs("bad", "worse"), 2)
    monkeypatch.undo()
    proc.process_batch(msgs(event(event_id="c")), 2)
    proc.process_batch(msgs("late"), 3)
    assert counts() == (3, 3)


def test_the_next_number_is_found_without_reading_all_commits(spark, tmp_root, monkeypatch):
    proc = TelemetryProcessor(tmp_root)
    batch = spark.createDataFrame([(bytearray(event().encode()),)], "value binary")
    proc.process_batch(batch, 0)

    def never(*a):
        raise AssertionError("all manifests were read")
    monkeypatch.setattr(store, "manifests", never)
    for i in (1, 2, 3):
        proc.process_batch(batch, i)
    monkeypatch.undo()
    assert sorted(r.snapshot_id for r in store.commits(spark, tmp_root).collect()) == [1, 2, 3, 4]
    assert store.snapshot_for(spark, tmp_root, "manual/2", known=1) == 3


def test_a_batch_runs_no_aggregate_of_its_own(spark, tmp_root):
    """Counts are observed by the job that writes: two jobs for the sides, one row for the manifest."""
    proc = TelemetryProcessor(tmp_root)
    batch = spark.createDataFrame([(bytearray(event(event_id=str(i)).encode()),) for i in range(9)], "value binary")
    proc.process_batch(batch, 0)
    tracker = spark.sparkContext.statusTracker()
    group = "one batch"
    spark.sparkContext.setJobGroup(group, group)
    try:
        proc.process_batch(batch, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) <= 4  # emptiness, two sides, manifest
    assert proc.last_counts[1] == (9, 0)
