"""Train and evaluate experiments against the versioned store.

``run_training`` reads clean events as of a snapshot (recording the snapshot
it used, the latest committed one by default), prepares the features, trains
the autoencoder and writes the run log, the weights and -- when asked -- the
evaluation. ``run_evaluation`` evaluates a stored experiment (the latest
when no id is given) with the *stored* scaler and snapshot, so an evaluation
scores exactly the data the model was trained on.
"""

from __future__ import annotations

import datetime as _dt
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from fleetscope.operators import experiments as E
from fleetscope.plans.dataset import prepare
from fleetscope.plans.evaluation import evaluate, run_log
from fleetscope.plans.training import train
from fleetscope.schema import EVALUATION, RUN_LOG
from fleetscope.sources import runlogs, store

MODELS = StructType([StructField("weights", ArrayType(DoubleType())),
                     StructField("experiment_id", StringType())])


def _paths(exp_root: str) -> dict[str, str]:
    return {k: os.path.join(exp_root, k) for k in ("run_logs", "evaluations", "models")}


def run_training(spark: SparkSession, store_root: str, exp_root: str, epochs: int = 50,
                 lr: float = 1e-3, patience: int = 5, batch_size: int = 32,
                 snapshot_id: int | None = None, evaluate_after: bool = True,
                 seed: int = 0) -> str:
    snap = snapshot_id or store.latest_snapshot(spark, store_root, "clean_events")
    clean = store.read_snapshots(spark, store_root, "clean_events", snap)
    p = prepare(clean, min_rows=5)
    res = train(spark, p.part("train"), p.part("val"), epochs=epochs, lr=lr,
                patience=patience, batch_size=batch_size, seed=seed)
    exp_id = f"exp_{_dt.datetime.now().strftime('%Y%m%d_%H%M%S_%f')}"
    paths = _paths(exp_root)
    hyper = {"epochs": epochs, "lr": lr, "batch_size": batch_size, "patience": patience}
    runlogs.write_reports(run_log(spark, p, res, exp_id, hyper, snap), paths["run_logs"])
    weights = spark.createDataFrame([([float(x) for x in res.theta], exp_id)], MODELS)
    (weights.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment_id").parquet(paths["models"]))
    if evaluate_after:
        runlogs.write_reports(evaluate(spark, p, res.theta, exp_id), paths["evaluations"])
    return exp_id


def read_logs(spark: SparkSession, exp_root: str) -> tuple[DataFrame, DataFrame]:
    paths = _paths(exp_root)
    return (runlogs.read_reports(spark, paths["run_logs"], RUN_LOG),
            runlogs.read_reports(spark, paths["evaluations"], EVALUATION))


def load_weights(spark: SparkSession, exp_root: str, experiment_id: str) -> np.ndarray:
    row = (spark.read.parquet(_paths(exp_root)["models"])
           .where(F.col("experiment_id") == experiment_id).select("weights").first())
    if row is None:
        raise KeyError(f"No model for experiment '{experiment_id}'")
    return np.array(row["weights"], dtype=float)


def stored_scaler(logs: DataFrame, experiment_id: str) -> DataFrame:
    """The scaler of a run as a frame (feature_index, feature_name, min, max)."""
    sp = logs.where(F.col("experiment_id") == experiment_id).select("scaler_params.*")
    z = F.arrays_zip(F.col("feature_names").alias("feature_name"), F.col("min").alias("data_min"),
                     F.col("max").alias("data_max"))
    return sp.select(F.posexplode(z).alias("feature_index", "s")).select(
        "feature_index", "s.feature_name", "s.data_min", "s.data_max")


def run_evaluation(spark: SparkSession, store_root: str, exp_root: str,
                   experiment_id: str | None = None) -> DataFrame:
    logs, evals = read_logs(spark, exp_root)
    if experiment_id is None:
        latest = E.latest_model(logs, evals).select("experiment_id").first()
        if latest is None:
            raise KeyError("No trained models found")
        experiment_id = latest["experiment_id"]
    log = logs.where(F.col("experiment_id") == experiment_id).select("dataset.snapshot_id").first()
    if log is None:
        raise KeyError(f"Experiment '{experiment_id}' not found")
    snap = int(log["snapshot_id"]) if log["snapshot_id"] else None
    clean = store.read_snapshots(spark, store_root, "clean_events", snap)
    p = prepare(clean, scaler=stored_scaler(logs, experiment_id), min_rows=5)
    report = evaluate(spark, p, load_weights(spark, exp_root, experiment_id), experiment_id)
    runlogs.write_reports(report, _paths(exp_root)["evaluations"])
    return report
