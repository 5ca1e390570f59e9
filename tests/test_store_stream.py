"""Versioned store (S4, S6, S7, A6), stream job (T1-T5, V8, V12) and gate (Q6)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, event

from fleetscope.operators import validate as V
from fleetscope.plans import frames
from fleetscope.plans.gate import run_aggregation, run_quality_gate
from fleetscope.sources import store
from fleetscope.sources.fixtures import telemetry_messages
from fleetscope.sources.messages import text_stream_source
from fleetscope.streaming.processor import TelemetryProcessor, stop


def write_message_files(spark, sf_dir, folder):
    """Split the fixture messages into one text file per delivery batch."""
    msgs = telemetry_messages(spark, sf_dir).select("snapshot_id", F.col("value").cast("string"))
    for sid in (1, 2, 3):
        (msgs.where(F.col("snapshot_id") == sid).select("value").coalesce(1)
         .write.mode("overwrite").text(os.path.join(folder, f"batch{sid}")))
    return [os.path.join(folder, f"batch{sid}") for sid in (1, 2, 3)]


def run_stream(spark, src, root, ckpt):
    q = TelemetryProcessor(root).start(text_stream_source(spark, src, max_files_per_trigger=1),
                                       ckpt, available_now=True)
    stop(q, 120)
    return q


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_root):
    staging = tempfile.mkdtemp(prefix="fleetscope-src-")
    batches = write_message_files(spark, SF001, staging)
    src = tempfile.mkdtemp(prefix="fleetscope-in-")
    # feed the three batches as three files in one folder
    for i, b in enumerate(batches):
        part = [f for f in os.listdir(b) if f.startswith("part-")][0]
        os.link(os.path.join(b, part), os.path.join(src, f"m{i}.txt"))
    ckpt = os.path.join(tmp_root, "_ckpt")
    run_stream(spark, src, tmp_root, ckpt)

    clean = store.read_snapshots(spark, tmp_root, "clean_events")
    dead = store.read_snapshots(spark, tmp_root, "dead_letter")
    batch_clean = frames.clean(spark, SF001, keep=())
    assert clean.count() == batch_clean.count() == 940
    assert dead.count() == 60
    cols = list(V.CLEAN_COLUMNS)
    assert clean.select(*cols).exceptAll(batch_clean.select(*cols)).count() == 0
    assert clean.where(F.col("processed_at").isNull()).count() == 0
    assert sorted(r[0] for r in store.commits(spark, tmp_root).select("snapshot_id").distinct().collect()) == [1, 2, 3]

    # replaying batch 0 of that stream rewrites its snapshot: nothing is duplicated
    keys = {r["batch_key"] for r in store.commits(spark, tmp_root).collect()}
    stream = next(iter(keys)).partition("/")[0]
    assert keys == {f"{stream}/{i}" for i in range(3)} and stream != "manual"
    proc = TelemetryProcessor(tmp_root)
    proc.stream = stream
    replay = spark.read.text(os.path.join(src, "m0.txt")).select(F.col("value").cast("binary"))
    proc.process_batch(replay, 0)
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 940

    # restart from the checkpoint: no new input, no new rows
    run_stream(spark, src, tmp_root, ckpt)
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 940

    # time travel: as of snapshot 1 only the first batch is visible
    # (a falsy id -- 0 or None -- means the latest committed snapshot; ids count from 1)
    first = store.read_snapshots(spark, tmp_root, "clean_events", as_of=1)
    want = frames.clean(spark, SF001).where("snapshot_id = 1").count()
    assert first.count() == want
    assert store.read_snapshots(spark, tmp_root, "clean_events", as_of=0).count() == 940

    # a new checkpoint counts its batches from 0 again and replaces nothing
    again = tempfile.mkdtemp(prefix="fleetscope-again-")
    with open(os.path.join(again, "n0.txt"), "w") as f:
        f.write(event(event_id="fresh") + "\n")
    run_stream(spark, again, tmp_root, os.path.join(tmp_root, "_ckpt2"))
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 941
    assert store.latest_snapshot(spark, tmp_root, "clean_events") == 4
    assert store.read_snapshots(spark, tmp_root, "clean_events", as_of=3).count() == 940


def test_empty_batch_writes_nothing(spark, tmp_root):
    empty = spark.createDataFrame([], "value binary")
    TelemetryProcessor(tmp_root).process_batch(empty, 5)
    assert store.commits(spark, tmp_root).count() == 0
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 0


def test_uncommitted_snapshot_is_invisible(spark, tmp_root):
    proc = TelemetryProcessor(tmp_root)
    msgs = spark.createDataFrame([(bytearray(event().encode()),)], "value binary")
    proc.process_batch(msgs, 0)
    # a writer died after its files but before its commit row
    extra = store.read_snapshots(spark, tmp_root, "clean_events").drop("snapshot_id")
    extra.write.mode("overwrite").parquet(os.path.join(tmp_root, "clean_events", "snapshot_id=2"))
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 1


def test_gate_alerts_on_fixture_and_aggregates_when_clean(spark, tmp_root):
    proc = TelemetryProcessor(tmp_root)
    proc.process_batch(telemetry_messages(spark, SF001).select("value"), 0)
    out = run_quality_gate(spark, tmp_root)
    assert out.action == "alert" and out.exit_code == 1 and out.rows_written == 0
    assert store.read_daily(spark, tmp_root, "hourly_aggregates").count() == 0

    good = tempfile.mkdtemp(prefix="fleetscope-good-")
    texts = [event(event_id=f"g{i}", value=float(i % 90),
                   timestamp=f"2026-04-02T{i % 24:02d}:{i % 60:02d}:00+00:00") for i in range(300)]
    TelemetryProcessor(good).process_batch(
        spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary"), 0)
    out = run_quality_gate(spark, good)
    assert out.action == "aggregate" and out.exit_code == 0
    n1 = store.read_daily(spark, good, "hourly_aggregates").count()
    assert n1 == out.rows_written > 0
    # A rerun without new snapshots has nothing to do; a full rerun
    # rewrites the same day instead of appending duplicates
    assert run_aggregation(spark, good) == 0
    run_aggregation(spark, good, incremental=False)
    assert store.read_daily(spark, good, "hourly_aggregates").count() == n1
    run_aggregation(spark, good, mode="append")
    assert store.read_daily(spark, good, "hourly_aggregates").count() == 2 * n1


def test_incremental_rollup_rewrites_only_touched_days(spark, tmp_root):
    from fleetscope.operators import rollup as A
    proc = TelemetryProcessor(tmp_root)
    day1 = [event(event_id=f"a{i}", value=float(i), timestamp=f"2026-04-01T{i % 24:02d}:00:00Z")
            for i in range(48)]
    day2 = [event(event_id=f"b{i}", value=float(i), timestamp=f"2026-04-02T{i % 24:02d}:00:00Z")
            for i in range(48)]
    to_df = lambda ts: spark.createDataFrame([(bytearray(t.encode()),) for t in ts], "value binary")
    proc.process_batch(to_df(day1 + day2), 1)
    assert run_aggregation(spark, tmp_root) == 48
    # a late event for day 1 arrives in a new batch: only day 1 is recomputed
    late = [event(event_id="late", value=500.0, timestamp="2026-04-01T05:30:00Z")]
    proc.process_batch(to_df(late), 2)
    assert run_aggregation(spark, tmp_root) == 24
    stored = store.read_daily(spark, tmp_root, "hourly_aggregates").drop("computed_at", "event_day")
    full = A.hourly_aggregates(store.read_snapshots(spark, tmp_root, "clean_events"))
    assert stored.count() == full.count() == 48
    assert stored.exceptAll(full.select(*stored.columns)).count() == 0
    assert stored.where(F.col("event_count") == 3).count() == 1


def test_missing_tables_read_empty_with_schema(spark, tmp_root):
    df = store.read_snapshots(spark, tmp_root, "dead_letter")
    assert df.count() == 0 and "rejection_reason" in df.columns


def test_processing_time_trigger_picks_up_new_files_and_stops(spark, tmp_root):
    import time
    src = tempfile.mkdtemp(prefix="fleetscope-live-")
    proc = TelemetryProcessor(tmp_root)
    q = proc.start(text_stream_source(spark, src), os.path.join(tmp_root, "_ckpt"),
                   processing_time="1 second")
    try:
        for i in range(2):
            with open(os.path.join(src, f".m{i}.tmp"), "w") as f:
                f.write(event(event_id=f"live{i}") + "\n")
            os.rename(os.path.join(src, f".m{i}.tmp"), os.path.join(src, f"m{i}.txt"))
            deadline = time.time() + 60
            while time.time() < deadline and len(proc.last_counts) <= i:
                time.sleep(0.5)
        assert q.isActive
    finally:
        stop(q, 5)
    assert not q.isActive
    assert store.read_snapshots(spark, tmp_root, "clean_events").count() == 2


def test_sql_views_over_the_store(spark, tmp_root):
    proc = TelemetryProcessor(tmp_root)
    proc.process_batch(telemetry_messages(spark, SF001).select("value"), 1)
    run_aggregation(spark, tmp_root)
    # an uncommitted batch directory must stay invisible to SQL too
    extra = store.read_snapshots(spark, tmp_root, "clean_events").drop("snapshot_id")
    extra.write.mode("overwrite").parquet(os.path.join(tmp_root, "clean_events", "snapshot_id=9"))
    store.register_tables(spark, tmp_root)
    store.register_tables(spark, tmp_root)  # idempotent
    total = spark.sql("SELECT COUNT(*) AS total_rows FROM telemetry_db.clean_events").first()[0]
    assert total == 940
    nulls = spark.sql("SELECT SUM(CASE WHEN location IS NULL THEN 1 ELSE 0 END) AS n "
                      "FROM telemetry_db.clean_events").first()[0]
    assert nulls > 0
    assert spark.sql("SELECT COUNT(*) FROM telemetry_db.dead_letter").first()[0] == 60
    assert spark.sql("SELECT COUNT(*) FROM telemetry_db.hourly_aggregates").first()[0] > 0


def test_sql_views_on_an_empty_store(spark, tmp_root):
    store.register_tables(spark, tmp_root, database="empty_db")
    assert spark.sql("SELECT COUNT(*) FROM empty_db.clean_events").first()[0] == 0
    assert "rejection_reason" in spark.table("empty_db.dead_letter").columns


def test_gate_on_an_empty_store_alerts_and_writes_nothing(spark, tmp_root):
    out = run_quality_gate(spark, tmp_root)
    assert out.action == "alert" and out.exit_code == 1
    assert [c["check"] for c in out.checks] == ["row_count", "null_rates", "value_ranges", "duplicates"]
    assert out.checks[0]["detail"] == "Total rows: 0 (threshold: >= 1)"
    assert run_aggregation(spark, tmp_root) == 0
    assert store.read_daily(spark, tmp_root, "hourly_aggregates").count() == 0
