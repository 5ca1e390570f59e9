"""S3: scans of the given parquet tables (column pruning left to Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.session import table_path

#: Session setting: tasks over which :func:`spread` deals a scan (unset: off).
SCAN_PARTITIONS = "spark.fleetscope.scanPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one parquet table; naming columns prunes the ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows of a scan over ``partitions`` tasks if the caller asks for it.

    A file that cannot be split (one row group) otherwise runs every per-row
    stage before the first shuffle in one task; a table in many splits needs
    nothing. The caller decides: ``partitions``, or the session's
    ``spark.fleetscope.scanPartitions``; unset means off. Rows are placed by a
    hash of the whole row, which is the same on a retry.
    """
    n = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n, F.xxhash64(*[F.col(c) for c in df.columns])) if n else df
