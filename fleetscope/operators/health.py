"""H1-H3: run rollups, run timeline and ingest lag."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.schema import (
    BADGE_FAIL, BADGE_OK, RUN_FAILED, RUN_SUCCESS, STATUS_DEGRADED, STATUS_HEALTHY,
    STATUS_RUNNING, STATUS_UNHEALTHY,
)


def run_rollup(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """H1: all success -> healthy; else any failed -> degraded; else running.

    Grouped by ``keys`` (none = one verdict over every run; an empty input then
    gives no row, which the caller reads as healthy).
    """
    st = F.col("state")
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.bool_and(st == RUN_SUCCESS).alias("_all_ok"),
        F.bool_or(st == RUN_FAILED).alias("_any_failed"),
    ).select(*keys, "runs",
             F.when(F.coalesce(F.col("_all_ok"), F.lit(True)), F.lit(STATUS_HEALTHY))
              .when(F.col("_any_failed"), F.lit(STATUS_DEGRADED))
              .otherwise(F.lit(STATUS_RUNNING)).alias("overall_status"))


def run_timeline(runs: DataFrame) -> DataFrame:
    """H2: per-run badge, newest first; anything but success shows FAIL."""
    return runs.select("dag_id", "run_id", "state", "execution_date", "duration_seconds",
                       F.when(F.col("state") == RUN_SUCCESS, F.lit(BADGE_OK))
                        .otherwise(F.lit(BADGE_FAIL)).alias("badge")) \
        .orderBy(F.col("execution_date").desc(), "dag_id", "run_id")


def _lag() -> Column:
    return F.col("latest_offset") - F.coalesce(F.col("committed_offset"), F.lit(-1))


def consumer_lag(latest: DataFrame, committed: DataFrame) -> DataFrame:
    """H3: per partition, latest minus committed offset: 0 when all is
    committed, ``latest + 1`` when nothing ever was (``committed`` null, as if -1)."""
    return (latest.join(committed, "partition", "left")
            .select("partition", "latest_offset", "committed_offset", _lag().alias("lag")))


def ingest_health(lag: DataFrame, topic: str) -> DataFrame:
    """H3 summary: the topic is present when it has partitions; total lag."""
    return lag.agg(F.count(F.lit(1)).alias("partitions"),
                   F.sum("lag").alias("total_lag")).select(
        F.lit(topic).alias("topic"), "partitions", "total_lag",
        F.when(F.col("partitions") > 0, F.lit(STATUS_HEALTHY)).otherwise(F.lit(STATUS_UNHEALTHY))
         .alias("status"))


def lag_rows(progress) -> list[tuple[str, int, int, int | None]]:
    """(topic, partition, latest, committed offset) from one StreamingQueryProgress. Its
    offsets name the next message; here, as in :func:`consumer_lag`, an offset is that of
    the last message, and committed is None where nothing was processed."""
    rows = []
    for src in progress.get("sources", []) or []:
        end, head = src.get("endOffset") or {}, src.get("latestOffset") or {}
        end, head = (_offsets(x) for x in (end, head))
        for topic, parts in head.items():
            for p, latest in parts.items():
                done = end.get(topic, {}).get(p)
                rows.append((topic, int(p), int(latest) - 1, int(done) - 1 if done else None))
    return rows


def _offsets(x) -> dict:
    """Offsets by topic and partition, from a dict, its JSON or (as PySpark's progress
    objects give them) its Python text; sources of another kind (files) have none."""
    if isinstance(x, str):
        try:
            x = json.loads(x)
        except ValueError:
            x = ast.literal_eval(x)
    return {t: p for t, p in x.items() if isinstance(p, dict)} if isinstance(x, dict) else {}


def lag_from_progress(spark, progress) -> DataFrame:
    """H3 live values from one StreamingQueryProgress (``query.lastProgress``), per
    (topic, partition)."""
    df = spark.createDataFrame(lag_rows(progress), "topic string, partition int, latest_offset long, "
                                                   "committed_offset long")
    return df.withColumn("lag", _lag())


def latest_lag(history: DataFrame) -> DataFrame:
    """H3 over the ingest history (see fleetscope.streaming.history): the lag per (topic,
    partition) as of each stream's newest batch."""
    newest = history.groupBy("stream").agg(F.max_by("lag", F.struct("at", "batch_id")).alias("lag"))
    return newest.select("stream", F.inline("lag")).withColumn("lag", _lag())


def ingest_totals(history: DataFrame) -> DataFrame:
    """V11 over the ingest history: valid, rejected and rejections by rule of each stream. A batch
    that was replayed counts once, as it went last."""
    last = (history.groupBy("stream", "batch_id").agg(F.max_by(F.struct("valid", "rejected", "rules"), "at").alias("b"))
            .select("stream", "b.*"))
    counts = last.groupBy("stream").agg(F.sum("valid").alias("valid"), F.sum("rejected").alias("rejected"))
    rules = (last.select("stream", F.explode("rules").alias("rule", "n")).groupBy("stream", "rule").agg(F.sum("n").alias("n"))
             .groupBy("stream").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n")))).alias("rules")))
    return counts.join(rules, "stream", "left")
