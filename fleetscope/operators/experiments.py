"""Experiment listing, detail, latest model and loss curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def experiment_list(logs: DataFrame, evals: DataFrame) -> DataFrame:
    """One row per run log in id order, metrics left-joined from its
    evaluation.

    A plain equi-join: AQE measures the evaluation side at runtime and
    broadcasts it only when it is small.
    """
    m = evals.select("experiment_id", F.col("metrics.precision").alias("precision"),
                     F.col("metrics.recall").alias("recall"), F.col("metrics.f1").alias("f1"))
    return logs.select(
        "experiment_id", "timestamp",
        F.col("results.best_val_loss").alias("best_val_loss"),
        F.col("hyperparameters.epochs_completed").alias("epochs_completed"),
        F.col("results.device").alias("device"),
    ).join(m, "experiment_id", "left").orderBy("experiment_id")


def experiment_detail(logs: DataFrame, evals: DataFrame, experiment_id: str) -> DataFrame:
    """The full log and evaluation of one run; a missing id raises."""
    one = logs.where(F.col("experiment_id") == experiment_id)
    if one.limit(1).count() == 0:
        raise KeyError(f"Experiment '{experiment_id}' not found")
    ev = evals.where(F.col("experiment_id") == experiment_id).select(
        "experiment_id", F.struct(*[c for c in evals.columns if c != "experiment_id"])
        .alias("evaluation"))
    return one.join(ev, "experiment_id", "left")


def latest_model(logs: DataFrame, evals: DataFrame, root: str = "experiments") -> DataFrame:
    """The run with the greatest id (ids embed their start time), as a
    top-1 of the logs before the join; no runs give no row. ``model_path`` is
    the folder that holds its weights."""
    best = logs.orderBy(F.desc("experiment_id")).limit(1)
    return (experiment_list(best, evals)
            .select("experiment_id",
                    F.concat(F.lit(root.rstrip("/") + "/models/experiment_id="), F.col("experiment_id"))
                    .alias("model_path"),
                    "best_val_loss", "precision", "recall", "f1"))


def loss_curve(logs: DataFrame) -> DataFrame:
    """(epoch, train, validation) per run; follows the train array's
    length, a missing validation value is null."""
    return logs.select("experiment_id", F.posexplode("losses.train").alias("pos", "train"),
                       F.col("losses.val").alias("_val")).select(
        "experiment_id", (F.col("pos") + 1).alias("epoch"), "train",
        F.try_element_at("_val", (F.col("pos") + 1).cast("int")).alias("validation"))
