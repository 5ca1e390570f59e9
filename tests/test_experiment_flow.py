"""Stream -> store -> train -> evaluate -> list, end to end on sf0.001."""

import os

from pyspark.sql import functions as F

from conftest import SF001

from fleetscope.operators import experiments as E
from fleetscope.plans.experiment import read_logs, run_evaluation, run_training, stored_scaler
from fleetscope.sources.fixtures import telemetry_messages
from fleetscope.streaming.processor import TelemetryProcessor


def test_train_then_evaluate_with_stored_scaler(spark, tmp_root):
    store_root = os.path.join(tmp_root, "store")
    exp_root = os.path.join(tmp_root, "experiments")
    msgs = telemetry_messages(spark, SF001)
    proc = TelemetryProcessor(store_root)
    for sid in (1, 2, 3):
        proc.process_batch(msgs.where(F.col("snapshot_id") == sid).select("value"), sid)

    exp_id = run_training(spark, store_root, exp_root, epochs=2, patience=1, snapshot_id=2,
                          evaluate_after=False)
    logs, evals = read_logs(spark, exp_root)
    assert logs.first()["dataset"]["snapshot_id"] == "2"
    assert evals.count() == 0
    sc = {r["feature_name"]: (r["data_min"], r["data_max"]) for r in stored_scaler(logs, exp_id).collect()}
    assert len(sc) == 5

    # data arrives after training; evaluation still scores snapshot 2 only
    rep = run_evaluation(spark, store_root, exp_root).first()
    assert rep["experiment_id"] == exp_id
    train_size = logs.first()["dataset"]["train_size"]
    assert rep["dataset"]["train_size"] == train_size
    logs, evals = read_logs(spark, exp_root)
    lst = E.experiment_list(logs, evals).first()
    assert lst["experiment_id"] == exp_id and lst["precision"] is not None


def test_cli_quality_exit_code(spark, tmp_root):
    from fleetscope.cli import main
    proc = TelemetryProcessor(tmp_root)
    proc.process_batch(telemetry_messages(spark, SF001).select("value"), 0)
    assert main(["quality", "--store", tmp_root]) == 1
