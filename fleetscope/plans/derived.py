"""Operational inputs derived from the given tables.

The catalog, health and experiment operators need a commit log, DAG runs,
topic offsets and run logs. Each is a deterministic projection of a given
table (events or embeddings), so these queries grow with the data and an
independent SQL engine can rebuild them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import validate as V
from fleetscope.plans import frames
from fleetscope.schema import (
    DAG_TELEMETRY, DAG_TRAINING, FUTURE_YEAR, METRICS, RUN_FAILED, RUN_RUNNING, RUN_SUCCESS,
)
from fleetscope.sources.tables import read_table, spread

# --- commit log ---------------------------------------------------------------


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (table, snapshot): committed_at, operation, rows.

    A snapshot is one delivery batch; each sink commits when its batch is
    processed, stamped with the newest event time it wrote (the batch runs
    right after its last event). The hourly table is rewritten per batch for
    the days the batch touched (dynamic partition overwrite), so its rows per
    snapshot are the batch's distinct (hour, device, metric) groups.

    One pass over the validated messages, aggregated in two levels: first
    per (snapshot, hour, device, metric, valid) -- dead rows collapse to one
    group per snapshot -- then per snapshot. Partial aggregation absorbs hot
    groups before either shuffle.
    """
    val = frames.validated(spark, sf_dir)
    ok = V.is_valid()
    ts = F.col("timestamp")
    real_ts = F.when(F.year(ts) < FUTURE_YEAR, ts)
    groups = val.groupBy(
        "snapshot_id", ok.alias("_ok"),
        F.when(ok, F.date_trunc("hour", ts)).alias("_hour"),
        F.when(ok, F.col("device_id")).alias("_device"),
        F.when(ok, F.col("metric_name")).alias("_metric"),
    ).agg(F.count(F.lit(1)).alias("_n"), F.max(real_ts).alias("_at"))
    g_ok = F.col("_ok")
    b = groups.groupBy("snapshot_id").agg(
        F.coalesce(F.sum(F.when(g_ok, F.col("_n"))), F.lit(0)).alias("clean_rows"),
        F.max(F.when(g_ok, F.col("_at"))).alias("clean_at"),
        F.coalesce(F.sum(F.when(~g_ok, F.col("_n"))), F.lit(0)).alias("dead_rows"),
        F.max(F.when(~g_ok, F.col("_at"))).alias("dead_at"),
        F.count_if(g_ok & F.col("_hour").isNotNull()).alias("hourly_rows"),
    )
    rows = F.array(
        F.struct(F.lit("clean_events").alias("table_name"), F.col("clean_at").alias("committed_at"),
                 F.lit("append").alias("operation"), F.col("clean_rows").alias("rows")),
        F.struct(F.lit("dead_letter").alias("table_name"), F.col("dead_at").alias("committed_at"),
                 F.lit("append").alias("operation"), F.col("dead_rows").alias("rows")),
        F.struct(F.lit("hourly_aggregates").alias("table_name"),
                 F.col("clean_at").alias("committed_at"), F.lit("overwrite").alias("operation"),
                 F.col("hourly_rows").alias("rows")),
    )
    out = b.select(F.col("snapshot_id").cast("long").alias("snapshot_id"), F.inline(rows))
    return out.where(F.col("rows") > 0).select(
        "table_name", "snapshot_id", frames.ntz("committed_at").alias("committed_at"),
        "operation", "rows")


# --- DAG runs and topic offsets -----------------------------------------------


def dag_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduler runs: one per event; state failed/running on fixed residues."""
    ev = spread(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value"))
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, F.lit(DAG_TELEMETRY))
         .otherwise(F.lit(DAG_TRAINING)).alias("dag_id"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_id") % 50 == 0, F.lit(RUN_FAILED))
         .when(F.col("event_id") % 50 == 1, F.lit(RUN_RUNNING))
         .otherwise(F.lit(RUN_SUCCESS)).alias("state"),
        F.col("ts").alias("execution_date"),
        F.col("value").alias("duration_seconds"),
    )


def topic_offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(latest, committed) offsets per partition of the message topic.

    The consumer has committed up to a point 100 offsets behind the head and
    has not committed offsets divisible by 97 (a model of a lagging consumer;
    every message is still read). Two aggregates and one small join; no
    window over a whole partition.
    """
    msgs = frames.messages(spark, sf_dir).select("partition", "offset")
    latest = msgs.groupBy("partition").agg(F.max("offset").alias("latest_offset"))
    committed = (msgs.join(latest, "partition")
                 .where((F.col("offset") % 97 != 0)
                        & (F.col("offset") < F.col("latest_offset") - 100))
                 .groupBy("partition").agg(F.max("offset").alias("committed_offset")))
    return latest, committed


# --- run logs -------------------------------------------------------------------


def run_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run logs built from ``embeddings``: loss curves are the vectors.

    ``losses.val`` is one item per epoch but the last two, so loss curves
    exercise missing validation values.
    """
    e = spread(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    train = F.transform("embedding", lambda x: x.cast("double"))
    e = e.select("vec_id", train.alias("train"))
    val = F.slice("train", 1, F.greatest(F.size("train") - 2, F.lit(0)))
    e = e.withColumn("val", val)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.col("vec_id"))
    return e.select(
        F.concat(F.lit("exp_"), F.lpad(F.col("vec_id").cast("string"), 6, "0")).alias("experiment_id"),
        F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct(F.lit(50).cast("long").alias("epochs_max"),
                 F.size("train").cast("long").alias("epochs_completed"),
                 F.lit(0.001).alias("learning_rate"), F.lit(32).cast("long").alias("batch_size"),
                 F.lit(5).cast("long").alias("patience"), F.lit(len(METRICS)).cast("long").alias("input_dim"),
                 F.lit(0.2).alias("dropout_rate")).alias("hyperparameters"),
        F.struct(F.lit(None).cast("string").alias("snapshot_id"),
                 F.lit(None).cast("long").alias("train_size"),
                 F.lit(None).cast("long").alias("val_size"),
                 F.lit(None).cast("long").alias("test_size")).alias("dataset"),
        F.struct(F.array_min("val").alias("best_val_loss"),
                 F.element_at("train", -1).alias("final_train_loss"),
                 (F.size("train") * 0.1).alias("training_time_seconds"),
                 F.lit("cpu").alias("device")).alias("results"),
        F.struct(F.col("train"), F.col("val")).alias("losses"),
        F.struct(F.array(*[F.lit(0.0)] * len(METRICS)).alias("min"),
                 F.array(*[F.lit(1.0)] * len(METRICS)).alias("max"),
                 F.array(*[F.lit(m) for m in METRICS]).alias("feature_names")).alias("scaler_params"),
    )


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation reports, present for runs whose id is not divisible by 3.

    Evaluation is optional per run; the missing third is what makes the
    experiment list's left join meaningful. Every run still appears in the
    list -- this shapes the input, it does not trim any query.
    """
    e = spread(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    e = e.where(F.col("vec_id") % 3 != 0)
    p = F.abs(F.element_at("embedding", 1).cast("double"))
    r = F.abs(F.element_at("embedding", 2).cast("double"))
    return e.select(
        F.concat(F.lit("exp_"), F.lpad(F.col("vec_id").cast("string"), 6, "0")).alias("experiment_id"),
        F.struct(p.alias("precision"), r.alias("recall"),
                 (F.lit(2.0) * p * r / F.greatest(p + r, F.lit(1e-8))).alias("f1")).alias("metrics"),
    )
