"""Catalog views over the versioned tables and their commit log.

The commit log has one row per (table, snapshot): when it was committed, the
operation and the rows it wrote. Every catalog answer is an aggregate of that
log or of the tables themselves -- nothing is canned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetscope.schema import (
    BAND_GREEN, BAND_NONE, BAND_RED, BAND_YELLOW, DECLARED_NOT_NULL, QUALITY_GREEN,
    QUALITY_YELLOW, STALE_AFTER_MINUTES, STATUS_DEGRADED, STATUS_HEALTHY,
)

TABLE_ORDER = ("clean_events", "dead_letter", "hourly_aggregates")


def dataset_list(commits: DataFrame, quality: DataFrame | None = None,
                 scored_table: str = "clean_events", counts: DataFrame | None = None) -> DataFrame:
    """Per table row count, last update, snapshot count, quality score.

    ``quality_score`` is the share of passed quality checks for
    ``scored_table`` and null for the others. ``counts`` (table_name,
    row_count): the rows that the tables hold now; a table that is missing
    there, or without it all, is the sum of its commits, which is right for tables that are
    only appended to.
    """
    out = commits.groupBy("table_name").agg(
        F.sum("rows").alias("row_count"),
        F.max("committed_at").alias("last_updated"),
        F.count(F.lit(1)).alias("snapshot_count"))
    if counts is not None:
        now = counts.select("table_name", F.col("row_count").alias("_now"))
        out = (out.join(now, "table_name", "left")
               .withColumn("row_count", F.coalesce("_now", "row_count")).drop("_now"))
    score: Column = F.lit(None).cast("double")
    if quality is not None:
        s = quality.select(F.avg(F.col("passed").cast("double"))).scalar()
        score = F.when(F.col("table_name") == scored_table, s)
    return out.withColumn("quality_score", score)


def table_detail(name: str, schema: StructType, tables: DataFrame) -> DataFrame:
    """One row per column with type and declared nullability, plus the
    table's summary. ``tables`` is the C1 frame; an unknown name raises."""
    declared = DECLARED_NOT_NULL.get(name)
    if declared is None:
        raise KeyError(f"Table '{name}' not found")
    cols = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString().upper()).alias("data_type"),
                              F.lit(f.name not in declared).alias("nullable"))
                     for i, f in enumerate(schema.fields)])
    return (tables.where(F.col("table_name") == name)
            .select("table_name", "row_count", "last_updated", "snapshot_count",
                    "quality_score", F.inline(cols)))


def snapshot_list(commits: DataFrame, table: str | None = None) -> DataFrame:
    """The commits of one table (or all), id as text like the API; an
    unknown table raises as in C2."""
    if table is not None and table not in DECLARED_NOT_NULL:
        raise KeyError(f"Table '{table}' not found")
    c = commits if table is None else commits.where(F.col("table_name") == table)
    return c.select("table_name", F.col("snapshot_id").cast("string").alias("snapshot_id"),
                    "committed_at", "operation", "rows")


def table_sample(table: DataFrame, order: list[str], snapshot_id: int | None = None,
                 limit: int = 10) -> DataFrame:
    """C4: the first ``limit`` rows by key, optionally as of a snapshot.

    A top-k (each task keeps its k best, one merge), not a full sort.
    """
    t = table if not snapshot_id else table.where(F.col("snapshot_id") <= int(snapshot_id))
    return t.orderBy(*order).limit(limit)


def dataset_totals(tables: DataFrame) -> DataFrame:
    """Number of tables, total rows, total snapshots."""
    return tables.agg(F.count(F.lit(1)).alias("tables"),
                      F.sum("row_count").alias("total_rows"),
                      F.sum("snapshot_count").alias("total_snapshots"))


def quality_band(score: Column) -> Column:
    """Green >= 0.9, yellow >= 0.7, else red; no score -> N/A."""
    return (F.when(score.isNull(), F.lit(BAND_NONE))
            .when(score >= QUALITY_GREEN, F.lit(BAND_GREEN))
            .when(score >= QUALITY_YELLOW, F.lit(BAND_YELLOW))
            .otherwise(F.lit(BAND_RED)))


def quality_bands(tables: DataFrame) -> DataFrame:
    s = F.col("quality_score")
    return tables.select("table_name", "quality_score", quality_band(s).alias("band"),
                         F.round(s * 100).alias("percent"))


def freshness(tables: DataFrame, as_of: Column,
              max_age_minutes: int = STALE_AFTER_MINUTES) -> DataFrame:
    """Stale when the last commit is older than ``max_age`` before ``as_of``
    (the caller's clock; a table that was never written is stale)."""
    limit = as_of - F.make_dt_interval(mins=F.lit(max_age_minutes))
    return tables.select("table_name", "last_updated", "row_count",
                         F.coalesce(F.col("last_updated") < limit, F.lit(True)).alias("is_stale"))


def storage_status(fresh: DataFrame) -> DataFrame:
    """Healthy iff no table is stale."""
    return fresh.agg(
        F.count_if("is_stale").alias("stale_tables"),
        F.when(F.coalesce(F.bool_or("is_stale"), F.lit(False)), F.lit(STATUS_DEGRADED))
         .otherwise(F.lit(STATUS_HEALTHY)).alias("status"))
