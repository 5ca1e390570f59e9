"""Catalog, health and experiment answers over a real store.

The same operators that the registered queries apply to derived inputs, here
over the commit log, the tables and the run logs that the jobs have written.
Unknown names raise ``KeyError`` (not found).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import catalog as C
from fleetscope.operators import experiments as E
from fleetscope.operators import health as H
from fleetscope.operators import quality as Q
from fleetscope.plans.experiment import read_logs
from fleetscope.schema import STALE_AFTER_MINUTES, TABLES
from fleetscope.sources import store
from fleetscope.streaming.history import ingest_history

_ORDER = {"clean_events": ["timestamp", "event_id"], "dead_letter": ["event_id", "original_data"],
          "hourly_aggregates": ["hour_window", "device_id", "metric_name"]}


def read_table(spark: SparkSession, root: str, table: str, as_of: int | None = None) -> DataFrame:
    if table not in TABLES:
        raise KeyError(f"Table '{table}' not found")
    if table == "hourly_aggregates":
        return store.read_daily(spark, root, table)
    return store.read_snapshots(spark, root, table, as_of)


def tables(spark: SparkSession, root: str) -> DataFrame:
    """Every declared table, written to or not. Row counts are what the tables
    hold now (from Parquet footers): the hourly table is rewritten by day, so
    its commits do not add up."""
    counts = None
    for name in TABLES:
        one = read_table(spark, root, name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    report = Q.quality_report(store.read_snapshots(spark, root, "clean_events"))
    listed = C.dataset_list(store.commits(spark, root), report, counts=counts)
    return counts.select("table_name", F.col("row_count").alias("_n")).join(listed, "table_name", "left").select(
        "table_name", F.coalesce("row_count", "_n").alias("row_count"), "last_updated",
        F.coalesce("snapshot_count", F.lit(0)).alias("snapshot_count"), "quality_score")


def table_detail(spark: SparkSession, root: str, table: str) -> DataFrame:
    """C2."""
    if table not in TABLES:
        raise KeyError(f"Table '{table}' not found")
    return C.table_detail(table, TABLES[table], tables(spark, root))


def snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    """C3."""
    return C.snapshot_list(store.commits(spark, root), table)


def sample(spark: SparkSession, root: str, table: str, snapshot_id: int | None = None,
           limit: int = 10) -> DataFrame:
    """C4: the first rows by key, as of a snapshot if one is given. The hourly
    table keeps its latest state only: a snapshot of it raises."""
    if table == "hourly_aggregates" and snapshot_id:
        raise ValueError("the hourly table has no earlier snapshots")
    return C.table_sample(read_table(spark, root, table, snapshot_id), _ORDER.get(table, []), limit=limit)


def totals(spark: SparkSession, root: str) -> DataFrame:
    """C5."""
    return C.dataset_totals(tables(spark, root))


def bands(spark: SparkSession, root: str) -> DataFrame:
    """C6."""
    return C.quality_bands(tables(spark, root))


def freshness(spark: SparkSession, root: str, as_of: Column | _dt.datetime,
              max_age_minutes: int = STALE_AFTER_MINUTES) -> DataFrame:
    """C7 at the caller's clock."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return C.freshness(tables(spark, root), now, max_age_minutes)


def storage_status(spark: SparkSession, root: str, as_of: Column | _dt.datetime,
                   max_age_minutes: int = STALE_AFTER_MINUTES) -> DataFrame:
    """C8."""
    return C.storage_status(freshness(spark, root, as_of, max_age_minutes))


def ingest_health(spark: SparkSession, progress: dict, topic: str) -> DataFrame:
    """H3 from a live query's progress (``query.lastProgress``)."""
    return H.ingest_health(H.lag_from_progress(spark, progress).where(F.col("topic") == topic), topic)


def past_ingest_health(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """H3 as of the newest batches that the store's ingest history holds."""
    return H.ingest_health(H.latest_lag(ingest_history(spark, root)).where(F.col("topic") == topic), topic)


def ingest_totals(spark: SparkSession, root: str) -> DataFrame:
    """V11 over all batches of every stream."""
    return H.ingest_totals(ingest_history(spark, root))


def experiments(spark: SparkSession, exp_root: str) -> DataFrame:
    """E1."""
    return E.experiment_list(*read_logs(spark, exp_root))


def experiment(spark: SparkSession, exp_root: str, experiment_id: str) -> DataFrame:
    """E2."""
    return E.experiment_detail(*read_logs(spark, exp_root), experiment_id)


def latest_model(spark: SparkSession, exp_root: str) -> DataFrame:
    """E3; no runs raise ``KeyError``."""
    found = E.latest_model(*read_logs(spark, exp_root), root=exp_root)
    if found.isEmpty():
        raise KeyError("No trained models found")
    return found


def loss_curve(spark: SparkSession, exp_root: str, experiment_id: str) -> DataFrame:
    """E4."""
    logs, _ = read_logs(spark, exp_root)
    return E.loss_curve(logs.where(F.col("experiment_id") == experiment_id)).orderBy("epoch")
