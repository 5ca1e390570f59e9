"""M13 + S8: evaluate a trained model and assemble the run log and report.

Errors, thresholds, statistics, flags and the confusion counts are Spark
aggregates over the prepared splits; only their one-row results (a dozen
numbers) reach the driver to be nested into the report row.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import autoencoder as AE
from fleetscope.operators import scoring as M
from fleetscope.plans.dataset import Prepared
from fleetscope.plans.training import TrainResult
from fleetscope.schema import METRICS, SYNTHETIC_MIN_ROWS


def measure(spark: SparkSession, prepared: Prepared, recon: M.Reconstructor,
            approx: bool = False) -> dict:
    """All numbers of the report. The splits and the synthetic rows are scored
    together, once; thresholds, statistics and confusion counts are read off
    the kept (split, error) pairs in one aggregate."""
    n_test = prepared.size_of("test")
    syn = M.synthetic_anomalies(spark, n_test).select(*METRICS, F.lit("synthetic").alias("split"))
    rows = prepared.split.select(*METRICS, "split").unionByName(syn)
    errors = M.reconstruction_errors(rows, recon).select("split", "error").persist()
    try:
        lim = M.threshold_values(M.thresholds(errors.where(F.col("split") == "train"), approx=approx))
        flagged = F.col("error") > F.lit(lim["p95"])
        on = lambda part, hit: F.count_if((F.col("split") == part) & hit)
        stats = M.error_stats(errors, on("synthetic", flagged).alias("true_positives"),
                              on("test", flagged).alias("false_positives"),
                              on("synthetic", ~flagged).alias("false_negatives"),
                              on("test", ~flagged).alias("true_negatives")).first().asDict()
    finally:
        errors.unpersist()
    return lim | stats | {"train_size": prepared.size_of("train"), "test_size": n_test,
                          "synthetic_anomalies": max(n_test, SYNTHETIC_MIN_ROWS)}


COUNTS = ("true_positives", "false_positives", "false_negatives", "true_negatives")
STATS = ("train_mean", "train_std", "test_mean", "test_std")
SIZES = ("train_size", "test_size", "synthetic_anomalies")


def summary(spark: SparkSession, numbers: dict) -> DataFrame:
    """The numbers of :func:`measure` with the metrics of the counts, as one row."""
    row = spark.range(1).select(
        *[F.lit(int(numbers[k])).cast("long").alias(k) for k in (*COUNTS, *SIZES)],
        *[F.lit(numbers[k]).cast("double").alias(k) for k in ("p95", "p99", *STATS)])
    return M.detection_metrics(row, keep=row.columns)


def evaluate(spark: SparkSession, prepared: Prepared, theta: np.ndarray,
             experiment_id: str, approx: bool = False) -> DataFrame:
    """The evaluation report as one nested row (EVALUATION schema)."""
    row = summary(spark, measure(spark, prepared, AE.reconstructor(spark, theta), approx))
    return row.select(
        F.lit(experiment_id).alias("experiment_id"),
        F.lit(_dt.datetime.now().isoformat()).alias("evaluation_timestamp"),
        F.struct("p95", "p99").alias("thresholds"), F.struct(*STATS).alias("error_statistics"),
        F.struct("precision", "recall", "f1").alias("metrics"),
        F.struct(*COUNTS).alias("confusion_matrix"), F.struct(*SIZES).alias("dataset"))


def run_log(spark: SparkSession, prepared: Prepared, result: TrainResult, experiment_id: str,
            hyper: dict, snapshot_id=None) -> DataFrame:
    """The run log as one nested row (RUN_LOG schema)."""
    sizes = {k: prepared.size_of(k) for k in ("train", "val", "test")}
    scaler = prepared.scaler.orderBy("feature_index").collect()
    base = prepared.scaler.agg(F.count(F.lit(1)).alias("_n"))
    return base.select(
        F.lit(experiment_id).alias("experiment_id"),
        F.lit(_dt.datetime.now().isoformat()).alias("timestamp"),
        F.struct(F.lit(hyper["epochs"]).cast("long").alias("epochs_max"),
                 F.lit(result.epochs_completed).cast("long").alias("epochs_completed"),
                 F.lit(float(hyper["lr"])).alias("learning_rate"),
                 F.lit(hyper["batch_size"]).cast("long").alias("batch_size"),
                 F.lit(hyper["patience"]).cast("long").alias("patience"),
                 F.lit(len(METRICS)).cast("long").alias("input_dim"),
                 F.lit(0.2).alias("dropout_rate")).alias("hyperparameters"),
        F.struct(F.lit(None if snapshot_id is None else str(snapshot_id)).cast("string").alias("snapshot_id"),
                 *[F.lit(int(sizes.get(k, 0))).cast("long").alias(f"{k}_size")
                   for k in ("train", "val", "test")]).alias("dataset"),
        F.struct(F.lit(float(result.best_val_loss)).alias("best_val_loss"),
                 F.lit(float(result.train_losses[-1])).alias("final_train_loss"),
                 F.lit(float(result.seconds)).alias("training_time_seconds"),
                 F.lit("spark").alias("device")).alias("results"),
        F.struct(F.array(*[F.lit(float(x)) for x in result.train_losses]).alias("train"),
                 F.array(*[F.lit(float(x)) for x in result.val_losses]).alias("val")).alias("losses"),
        F.struct(F.array(*[F.lit(float(r["data_min"])) for r in scaler]).alias("min"),
                 F.array(*[F.lit(float(r["data_max"])) for r in scaler]).alias("max"),
                 F.array(*[F.lit(r["feature_name"]) for r in scaler]).alias("feature_names"))
         .alias("scaler_params"),
    )
