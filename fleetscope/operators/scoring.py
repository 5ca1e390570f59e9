"""Reconstruction error, thresholds, flags and detection metrics.

A *reconstructor* maps a frame with the feature columns to the same frame
plus ``xhat_<feature>`` columns. The autoencoder (fleetscope.operators
.autoencoder) is one; :func:`mean_reconstructor` is a fixed linear one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.numeric import hash_uniform
from fleetscope.functions.ranking import approx_quantiles, exact_quantiles
from fleetscope.schema import (
    F1_FLOOR, METRICS, SYNTHETIC_MIN_ROWS, SYNTHETIC_SEED, THRESHOLD_QUANTILES,
)

Reconstructor = Callable[[DataFrame], DataFrame]


def mean_reconstructor(train: DataFrame, metrics: Sequence[str] = METRICS) -> Reconstructor:
    """Predict every row as the training column means (fitted once)."""
    fitted = train.agg(*[F.avg(m).alias(m) for m in metrics]).first()
    means = [F.lit(fitted[m]).cast("double").alias(f"xhat_{m}") for m in metrics]

    def recon(df: DataFrame) -> DataFrame:
        return df.select("*", *means)
    return recon


def squared_error(metrics: Sequence[str] = METRICS) -> Column:
    """M6: mean over the features of the squared difference."""
    total = None
    for m in metrics:
        d = F.col(m) - F.col(f"xhat_{m}")
        total = d * d if total is None else total + d * d
    return total / F.lit(float(len(metrics)))


def reconstruction_errors(df: DataFrame, recon: Reconstructor,
                          metrics: Sequence[str] = METRICS) -> DataFrame:
    out = recon(df).withColumn("error", squared_error(metrics))
    return out.drop(*[f"xhat_{m}" for m in metrics])


def thresholds(train_errors: DataFrame, approx: bool = False) -> DataFrame:
    """M7: p95 and p99 of the training errors (exact, linear interpolation).

    ``approx=True`` swaps in a mergeable quantile sketch.
    """
    if approx:
        return approx_quantiles(train_errors, "error", THRESHOLD_QUANTILES, ["p95", "p99"])
    return exact_quantiles(train_errors, "error", THRESHOLD_QUANTILES, ["p95", "p99"])


def error_stats(errors: DataFrame, *more: Column) -> DataFrame:
    """M8: mean and population std of the errors, train and test (and what
    else the caller wants from the same pass)."""
    def on(part: str) -> Column:
        return F.when(F.col("split") == part, F.col("error"))
    return errors.agg(F.avg(on("train")).alias("train_mean"),
                      F.stddev_pop(on("train")).alias("train_std"),
                      F.avg(on("test")).alias("test_mean"),
                      F.stddev_pop(on("test")).alias("test_std"), *more)


def threshold_values(limits: DataFrame) -> dict[str, float]:
    """The two thresholds as numbers (one row, fetched once)."""
    r = limits.first()
    return {"p95": r["p95"], "p99": r["p99"]}


def flag(errors: DataFrame, limits) -> DataFrame:
    """M9: strictly above each threshold (``limits``: frame or values)."""
    lim = threshold_values(limits) if isinstance(limits, DataFrame) else limits
    return errors.withColumn("flag_p95", F.col("error") > F.lit(lim["p95"])) \
                 .withColumn("flag_p99", F.col("error") > F.lit(lim["p99"]))


def synthetic_anomalies(spark: SparkSession, n_test: int,
                        metrics: Sequence[str] = METRICS,
                        seed: int = SYNTHETIC_SEED) -> DataFrame:
    """max(n_test, 5) rows uniform in [0, 1), the first and third
    features redrawn in [0.9, 1.0). Uniforms are md5 hashes of
    (seed, row, draw) so every engine reproduces them; the rows are generated
    in parallel by ``range``."""
    n = max(int(n_test), SYNTHETIC_MIN_ROWS)
    ids = spark.range(n).withColumnRenamed("id", "syn_id")
    cols = []
    for j, m in enumerate(metrics):
        u = hash_uniform(F.col("syn_id"), F.lit(j), seed=seed)
        if j in (0, 2):
            u = F.lit(0.9) + F.lit(0.1) * hash_uniform(F.col("syn_id"), F.lit(j + len(metrics)), seed=seed)
        cols.append(u.alias(m))
    return ids.select("syn_id", *cols)


def confusion(test_flags: DataFrame, synthetic_flags: DataFrame) -> DataFrame:
    """Synthetic rows flagged are true positives, test rows flagged are
    false positives (the test split holds only validated data)."""
    sides = (test_flags.select("flag_p95", F.lit(False).alias("synthetic"))
             .unionByName(synthetic_flags.select("flag_p95", F.lit(True).alias("synthetic"))))
    flagged, syn = F.col("flag_p95"), F.col("synthetic")
    return sides.agg(F.count_if(syn & flagged).alias("true_positives"),
                     F.count_if(~syn & flagged).alias("false_positives"),
                     F.count_if(syn & ~flagged).alias("false_negatives"),
                     F.count_if(~syn & ~flagged).alias("true_negatives"))


def detection_metrics(cm: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 with the reference's floors."""
    tp, fp, fn = (F.col("true_positives"), F.col("false_positives"),
                  F.col("false_negatives"))
    precision = tp / F.greatest(tp + fp, F.lit(1))
    recall = tp / F.greatest(tp + fn, F.lit(1))
    return cm.select(*keep, precision.alias("precision"), recall.alias("recall")).select(
        *keep, "precision", "recall",
        (F.lit(2.0) * F.col("precision") * F.col("recall")
         / F.greatest(F.col("precision") + F.col("recall"), F.lit(F1_FLOOR))).alias("f1"))
