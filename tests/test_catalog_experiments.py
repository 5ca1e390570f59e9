"""Catalog (C1-C8), health (H1-H3), run logs and experiments."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from fleetscope.operators import catalog as C
from fleetscope.operators import experiments as E
from fleetscope.operators import health as H
from fleetscope.plans import derived
from fleetscope.schema import CLEAN_EVENTS, EVALUATION, RUN_LOG
from fleetscope.sources import runlogs


def test_table_detail_and_unknown_table(spark):
    tables = C.dataset_list(derived.commits(spark, SF001))
    d = C.table_detail("clean_events", CLEAN_EVENTS, tables).orderBy("position").collect()
    assert [r["column_name"] for r in d][:2] == ["event_id", "timestamp"]
    assert [r["nullable"] for r in d] == [False] * 7 + [True]
    with pytest.raises(KeyError):
        C.table_detail("nope", CLEAN_EVENTS, tables)


def test_commit_rows_add_up(spark):
    tables = {r["table_name"]: r for r in C.dataset_list(derived.commits(spark, SF001)).collect()}
    assert tables["clean_events"]["row_count"] == 940
    assert tables["dead_letter"]["row_count"] == 60
    assert tables["clean_events"]["snapshot_count"] == 3


def test_bands_and_freshness(spark):
    df = spark.createDataFrame([("a", 0.95), ("b", 0.7), ("c", 0.69), ("d", None)],
                               "table_name string, quality_score double")
    got = {r["table_name"]: (r["band"], r["percent"]) for r in C.quality_bands(df).collect()}
    assert got == {"a": ("green", 95.0), "b": ("yellow", 70.0), "c": ("red", 69.0), "d": ("N/A", None)}
    t = spark.createDataFrame([("x", "2026-01-01 10:00:00", 1), ("y", "2026-01-01 10:31:00", 1)],
                              "table_name string, last_updated string, row_count long") \
        .withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))
    now = F.lit("2026-01-01 10:31:00").cast("timestamp_ntz")
    fr = {r["table_name"]: r["is_stale"] for r in C.freshness(t, now).collect()}
    assert fr == {"x": True, "y": False}
    assert C.storage_status(C.freshness(t, now)).first()["status"] == "degraded"


def test_run_rollup_verdicts(spark):
    runs = spark.createDataFrame(
        [("a", "success"), ("a", "success"), ("b", "success"), ("b", "failed"), ("c", "running"),
         ("c", "success")], "dag_id string, state string")
    got = {r["dag_id"]: r["overall_status"] for r in H.run_rollup(runs, ["dag_id"]).collect()}
    assert got == {"a": "healthy", "b": "degraded", "c": "running"}
    assert H.run_rollup(runs.limit(0)).count() == 1  # global rollup over nothing: one row
    assert H.run_rollup(runs.limit(0)).first()["runs"] == 0


def test_lag_without_commits_is_whole_backlog(spark):
    latest = spark.createDataFrame([(0, 9)], "partition int, latest_offset long")
    committed = spark.createDataFrame([], "partition int, committed_offset long")
    assert H.consumer_lag(latest, committed).first()["lag"] == 10


def write_reference_layout(root, logs, evals):
    for log in logs:
        d = os.path.join(root, log["experiment_id"])
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "experiment.json"), "w") as f:
            json.dump(log, f, indent=2)
    for ev in evals:
        with open(os.path.join(root, ev["experiment_id"], "evaluation.json"), "w") as f:
            json.dump(ev, f, indent=2)
    os.makedirs(os.path.join(root, "exp_20260101_000000"), exist_ok=True)  # no log: skipped


def test_read_reference_run_logs_and_list(spark, tmp_root):
    logs = [{"experiment_id": f"exp_2026040{i}_120000", "timestamp": f"2026-04-0{i}T12:00:00",
             "hyperparameters": {"epochs_completed": 10 + i},
             "results": {"best_val_loss": 0.01 * i, "device": "cpu"},
             "losses": {"train": [0.3, 0.2, 0.1], "val": [0.35, 0.25]}} for i in (1, 2, 3)]
    evals = [{"experiment_id": "exp_20260402_120000", "metrics": {"precision": 1.0, "recall": 0.6, "f1": 0.75}}]
    write_reference_layout(tmp_root, logs, evals)
    L = runlogs.read_run_logs(spark, tmp_root)
    V = runlogs.read_evaluations(spark, tmp_root)
    lst = {r["experiment_id"]: r for r in E.experiment_list(L, V).collect()}
    assert len(lst) == 3
    assert lst["exp_20260402_120000"]["recall"] == 0.6 and lst["exp_20260401_120000"]["f1"] is None
    assert E.latest_model(L, V).first()["experiment_id"] == "exp_20260403_120000"
    curve = E.loss_curve(L.where(F.col("experiment_id") == "exp_20260401_120000")).orderBy("epoch").collect()
    assert [(r["epoch"], r["train"], r["validation"]) for r in curve] == [
        (1, 0.3, 0.35), (2, 0.2, 0.25), (3, 0.1, None)]
    with pytest.raises(KeyError):
        E.experiment_detail(L, V, "exp_missing")
    det = E.experiment_detail(L, V, "exp_20260402_120000").first()
    assert det["evaluation"]["metrics"]["f1"] == 0.75


def test_report_table_roundtrip(spark, tmp_root):
    logs = derived.run_logs(spark, SF001)
    path = os.path.join(tmp_root, "run_logs")
    runlogs.write_reports(logs, path)
    back = runlogs.read_reports(spark, path, RUN_LOG)
    assert back.count() == logs.count()
    assert back.select(F.sum(F.size("losses.train"))).first()[0] == \
        logs.select(F.sum(F.size("losses.train"))).first()[0]
    ev = derived.evaluations(spark, SF001)
    assert set(ev.columns) <= {f.name for f in EVALUATION.fields}


def test_catalog_over_a_live_store(spark, tmp_root):
    from fleetscope.operators import quality as Q
    from fleetscope.plans.gate import run_aggregation
    from fleetscope.sources import store
    from fleetscope.sources.fixtures import telemetry_messages
    from fleetscope.streaming.processor import TelemetryProcessor
    msgs = telemetry_messages(spark, SF001)
    proc = TelemetryProcessor(tmp_root)
    for sid in (1, 2, 3):
        proc.process_batch(msgs.where(F.col("snapshot_id") == sid).select("value"), sid)
    run_aggregation(spark, tmp_root)
    commits = store.commits(spark, tmp_root)
    clean = store.read_snapshots(spark, tmp_root, "clean_events")
    tables = {r["table_name"]: r for r in
              C.dataset_list(commits, Q.quality_report(clean)).collect()}
    assert tables["clean_events"]["row_count"] == 940 and tables["clean_events"]["snapshot_count"] == 3
    assert tables["dead_letter"]["row_count"] == 60
    assert tables["hourly_aggregates"]["row_count"] == store.read_daily(
        spark, tmp_root, "hourly_aggregates").count()
    assert tables["clean_events"]["quality_score"] == 0.25
    fresh = {r["table_name"]: r["is_stale"] for r in C.freshness(C.dataset_list(commits), F.current_timestamp()).collect()}
    assert fresh == {"clean_events": False, "dead_letter": False, "hourly_aggregates": False}
    later = F.current_timestamp() + F.expr("INTERVAL 31 MINUTES")  # a pipeline that has stopped
    assert all(r["is_stale"] for r in C.freshness(C.dataset_list(commits), later).collect())
    snaps = C.snapshot_list(commits, "clean_events").collect()
    assert sorted(r["snapshot_id"] for r in snaps) == ["1", "2", "3"]


def test_live_lag_from_progress(spark):
    prog = {"sources": [{"description": "KafkaV2[Subscribe[telemetry.raw]]",
                         "endOffset": {"telemetry.raw": {"0": 100, "1": 80}},
                         "latestOffset": {"telemetry.raw": {"0": 120, "1": 80, "2": 5}}}]}
    got = {r["partition"]: r["lag"] for r in H.lag_from_progress(spark, prog).collect()}
    assert got == {0: 20, 1: 0, 2: 5}
    assert H.lag_from_progress(spark, {"sources": []}).count() == 0


def test_live_lag_accepts_offsets_as_json_text(spark):
    prog = {"sources": [{"endOffset": '{"telemetry.raw":{"0":7}}',
                         "latestOffset": '{"telemetry.raw":{"0":9}}'}]}
    assert [r["lag"] for r in H.lag_from_progress(spark, prog).collect()] == [2]
