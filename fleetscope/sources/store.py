"""S4, S6, S7 + commit log: versioned tables on plain Parquet.

Layout under a root folder (a shared file system or object store on a
cluster)::

    <root>/<table>/snapshot_id=<n>/part-*.parquet        one directory per batch
    <root>/hourly_states/run=<r>/event_day=<d>/...        what a rollup run adds (A6)
    <root>/hourly_aggregates/run=<r>/event_day=<d>/...    the days it has changed (A6)
    <root>/_commits/unit=<u>/snapshot_id=<n>/             one manifest row each

A unit is what becomes visible together: a stream batch with its clean events and dead
letters ("batch"), a rollup run with its states and rows ("hourly"), or a table
written by itself. Its writer overwrites exactly its own directories and writes the one
manifest row last, so a replayed batch rewrites the same files (effectively
once), and of a half-written unit nothing is seen.

Snapshot ids count from 1 and come from the manifests: a stream batch is known
by its key (stream, batch id) and takes the next free number; replayed, it
finds its own number there, and another stream's batch never has the same one.
Readers take snapshots up to the newest committed id. One stream at a time writes
to a store. Reading "as of" a snapshot is a filter on the partition column,
which prunes directories at the scan.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fleetscope.schema import COMMITS, TABLES

COMMITS_DIR = "_commits"
#: The two tables of a stream batch, and the unit they are committed by.
BATCH_TABLES, BATCH = ("clean_events", "dead_letter"), "batch"
HOURLY, STATES = "hourly", "hourly_states"
_MANIFEST = ("committed_at timestamp, operation string, batch_key string, covers long, "
             "tables array<struct<table_name:string,rows:long>>, unit string, snapshot_id long")
#: Rollup runs that start anew, that add to the runs before, and that only append rows.
REBUILD, MERGE, APPEND = "overwrite", "merge", "append"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob pattern names anything, in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def empty_table(spark: SparkSession, table: str, with_snapshot: bool = True) -> DataFrame:
    """An empty frame with the table's declared schema."""
    fields = list(TABLES[table].fields)
    if with_snapshot:
        fields.append(StructField("snapshot_id", COMMITS["snapshot_id"].dataType))
    return spark.createDataFrame([], StructType(fields))


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Idempotent creation of the table folders (nothing else to declare:
    schemas are constants and enforced on write)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for t in (*TABLES, STATES, COMMITS_DIR):
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(root, t))
        p.getFileSystem(conf).mkdirs(p)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    path = os.path.join(root, COMMITS_DIR)
    if not _exists(spark, path):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(path)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """One row for each table and snapshot that has been committed."""
    rows = manifests(spark, root).select("snapshot_id", "committed_at", "operation", "batch_key", F.inline("tables"))
    return rows.where(F.col("table_name").isin(*TABLES)).select(*[f.name for f in COMMITS.fields])


def latest_snapshot(spark: SparkSession, root: str, table: str) -> int | None:
    row = commits(spark, root).where(F.col("table_name") == table) \
        .agg(F.max("snapshot_id")).first()
    return None if row is None else row[0]


def snapshot_for(spark: SparkSession, root: str, batch_key: str, known: int | None = None) -> int:
    """The snapshot id of a stream batch: its own one if it has been committed
    before, else the next after all commits of the stream tables.

    ``known``: a number up to which all commits are known not to be the batch's;
    only the manifests behind it are looked at, by name, so the work does not grow
    with the batches before."""
    if known is None:
        rows = manifests(spark, root).where(F.col("unit") != HOURLY)
        last, own = rows.agg(F.max("snapshot_id"), F.max(F.when(F.col("batch_key") == batch_key, F.col("snapshot_id")))).first()
        return own if own is not None else (last or 0) + 1
    snapshot = known + 1
    while _exists(spark, path := _manifest_path(root, BATCH, snapshot)):
        if spark.read.schema(_MANIFEST).parquet(path).where(F.col("batch_key") == batch_key).count():
            return snapshot
        snapshot += 1
    return snapshot


def _manifest_path(root: str, unit: str, snapshot_id: int) -> str:
    return os.path.join(root, COMMITS_DIR, f"unit={unit}", f"snapshot_id={int(snapshot_id)}")


def _conform(df: DataFrame, table: str) -> DataFrame:
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[table].fields]
    return df.select(*cols)


def _write(df: DataFrame, root: str, table: str, snapshot_id: int) -> str:
    path = os.path.join(root, table, f"snapshot_id={int(snapshot_id)}")
    _conform(df, table).write.mode("overwrite").parquet(path)
    return path


def write_snapshot(df: DataFrame, root: str, table: str, snapshot_id: int,
                   operation: str = "append", batch_key: str | None = None) -> int:
    """Write one table as snapshot ``snapshot_id`` and commit it by itself.

    Returns the rows written (read from the Parquet footers, not a rescan).
    """
    rows = df.sparkSession.read.parquet(_write(df, root, table, snapshot_id)).count()
    commit(df.sparkSession, root, {table: rows}, snapshot_id, operation, batch_key, unit=table)
    return rows


def write_batch(sides: dict[str, DataFrame], root: str, snapshot_id: int, counts: Callable[[], dict[str, int]],
                batch_key: str | None = None) -> dict[str, int]:
    """T4: write all tables of a batch, then make them visible by one manifest row.

    Empty sides are written, too: a side that an earlier, unfinished attempt has left
    is replaced. ``counts`` is called after the writes; tables without rows are not
    named in the manifest, and a batch without any row commits nothing."""
    spark = next(iter(sides.values())).sparkSession
    for table, df in sides.items():
        _write(df, root, table, snapshot_id)
    rows = {table: n for table, n in counts().items() if n}
    if rows:
        commit(spark, root, rows, snapshot_id, "append", batch_key, unit=BATCH)
    return rows


def commit(spark: SparkSession, root: str, rows: dict[str, int], snapshot_id: int, operation: str,
           batch_key: str | None = None, unit: str = BATCH, covers: int | None = None) -> None:
    """Write the manifest row of a unit's snapshot; replaced on replay. ``covers``: the
    newest clean snapshot that a rollup run has seen."""
    now = _dt.datetime.now(_dt.timezone.utc)  # zone-aware: no local-time reinterpretation
    tables = [{"table_name": t, "rows": int(n)} for t, n in rows.items()]
    fields = _MANIFEST.split(", unit")[0]
    row = spark.createDataFrame([(now, operation, batch_key, covers, tables)], fields)
    row.coalesce(1).write.mode("overwrite").parquet(_manifest_path(root, unit, snapshot_id))


def read_snapshots(spark: SparkSession, root: str, table: str,
                   as_of: int | None = None) -> DataFrame:
    """The table as of a snapshot (falsy = latest committed).

    Uncommitted directories are skipped; the bound is a literal, so the
    snapshot filter prunes partitions at planning time.
    """
    path = os.path.join(root, table)
    bound = latest_snapshot(spark, root, table)
    if as_of:
        bound = min(int(as_of), bound) if bound is not None else None
    if bound is None or not _exists(spark, path):
        return empty_table(spark, table)
    schema = StructType(list(TABLES[table].fields)
                        + [StructField("snapshot_id", COMMITS["snapshot_id"].dataType)])
    return (spark.read.schema(schema).parquet(path)
            .where(F.col("snapshot_id") <= F.lit(bound)))


def hourly_runs(spark: SparkSession, root: str) -> tuple[int, int | None, int]:
    """(the last rollup run, the clean snapshot that the kept states cover, the
    run from which on the states add up); 0, None, 0 before the first one."""
    runs = manifests(spark, root).where(F.col("unit") == HOURLY)
    kept = F.col("operation") != APPEND
    row = runs.agg(F.max("snapshot_id"), F.max(F.when(kept, F.col("covers"))),
                   F.max(F.when(F.col("operation") == REBUILD, F.col("snapshot_id")))).first()
    return row[0] or 0, row[1], row[2] or 0


def write_run(df: DataFrame, root: str, table: str, run: int) -> str:
    """The rows of a rollup run, in day directories of its own; seen once committed."""
    path = os.path.join(root, table, f"run={int(run)}")
    df.write.mode("overwrite").partitionBy("event_day").parquet(path)
    return path


def read_states(spark: SparkSession, root: str, schema: StructType, first: int, last: int) -> DataFrame:
    """The states of the runs ``first`` to ``last``, which add up; pruned by run."""
    return (spark.read.schema(StructType([*schema.fields, StructField("run", COMMITS["snapshot_id"].dataType)]))
            .parquet(os.path.join(root, STATES)).where(F.col("run").between(first, last)).drop("run"))


def _daily_sql(spark: SparkSession, root: str, columns: str) -> str | None:
    """The hourly table: of each day the rows of the newest run that has (re)written it, and of
    the runs that have appended to it since. None before the first commit."""
    runs = manifests(spark, root).where(F.col("unit") == HOURLY)
    last, appended = runs.agg(F.max("snapshot_id"), F.collect_list(
        F.when(F.col("operation") == APPEND, F.col("snapshot_id")))).first()
    path = os.path.join(root, "hourly_aggregates")
    if last is None or not _exists(spark, path):
        return None
    written = f"WHERE run NOT IN ({', '.join(map(str, sorted(appended)))})" if appended else ""
    return (f"WITH h AS (SELECT * FROM parquet.`{path}` WHERE run <= {last}), "
            f"k AS (SELECT event_day, max(run) AS since FROM h {written} GROUP BY event_day) "
            f"SELECT {columns} FROM h LEFT JOIN k USING (event_day) WHERE run >= coalesce(since, 0)")


def read_daily(spark: SparkSession, root: str, table: str = "hourly_aggregates") -> DataFrame:
    """The committed state of the hourly table, with its day."""
    names = [f.name for f in TABLES[table].fields]
    sql = _daily_sql(spark, root, ", ".join([*names, "event_day"]))
    if sql is None:
        return empty_table(spark, table, with_snapshot=False).withColumn("event_day", F.lit(None).cast("date"))
    return spark.sql(sql)


def register_tables(spark: SparkSession, root: str, database: str = "telemetry_db") -> list[str]:
    """S7 for SQL users: ``database`` plus one view per table over the store.

    Idempotent (``CREATE DATABASE IF NOT EXISTS``, ``CREATE OR REPLACE VIEW``).
    Each snapshot table's view is bounded by the newest committed snapshot
    when it is (re)registered, so ``SELECT ... FROM telemetry_db.clean_events``
    sees committed batches only; call again after new commits. Views over
    missing tables are empty with the declared schema.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table, schema in TABLES.items():
        columns = [f.name for f in schema.fields]
        if table == "hourly_aggregates":
            body = _daily_sql(spark, root, ", ".join([*columns, "event_day"]))
        else:
            bound = latest_snapshot(spark, root, table)
            body = None if bound is None else (
                f"SELECT {', '.join([*columns, 'snapshot_id'])} FROM parquet.`{os.path.join(root, table)}` WHERE snapshot_id <= {int(bound)}")
        if body is None:
            df = read_daily(spark, root) if table == "hourly_aggregates" else empty_table(spark, table)
            typed = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                              for f in df.schema.fields)
            body = f"SELECT {typed} WHERE false"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS {body}")
        names.append(f"{database}.{table}")
    return names
