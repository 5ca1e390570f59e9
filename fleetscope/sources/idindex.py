"""Q4 without a full shuffle: the ids of a table, kept bucketed by id.

``<root>/_ids`` holds (event_id, n) for every snapshot, partitioned by snapshot and bucketed by
``event_id``. A snapshot is added with one shuffle of its own ids. From then on the stored side never
moves: the distinct count over any range of snapshots, and the ids of a new snapshot that are
already known, are read bucket by bucket. Adding a snapshot again replaces its rows.

Bucketing lives in the session's catalog, so each session registers the table under a
name of its own; the files tell their buckets by name.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import quality as Q
from fleetscope.sources.store import _exists

FOLDER = "_ids"
BUCKETS = 64


class IdIndex:
    """``buckets`` is fixed when the index is first written; it bounds the tasks that read it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = f"ids_{uuid.uuid4().hex}"
        path = os.path.join(root, FOLDER)
        known = _exists(spark, path)
        spark.sql(f"CREATE TABLE {self.table} (event_id STRING, n BIGINT, snapshot_id BIGINT) USING parquet "
                  f"PARTITIONED BY (snapshot_id) CLUSTERED BY (event_id) SORTED BY (event_id) INTO {int(buckets)} BUCKETS "
                  f"LOCATION '{path}'")
        if known:
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def add(self, clean: DataFrame, snapshot_id: int) -> None:
        """Count the ids of a snapshot's rows; repeated, it replaces them."""
        counts = Q.id_counts(clean).repartition(self.buckets, "event_id")
        counts.createOrReplaceTempView(view := f"new_{self.table}")
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (snapshot_id = {int(snapshot_id)}) "
                           f"SELECT event_id, n FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def counts(self, as_of: int | None = None) -> DataFrame:
        """(event_id, n) over all snapshots up to ``as_of``; no exchange."""
        rows = self.spark.table(self.table)
        if as_of:
            rows = rows.where(F.col("snapshot_id") <= int(as_of))
        return rows.groupBy("event_id").agg(F.sum("n").alias("n"))

    def check_duplicates(self, as_of: int | None = None) -> DataFrame:
        """Q4: the row of :func:`fleetscope.operators.quality.check_duplicates`."""
        return Q.duplicates_from_counts(self.counts(as_of))

    def unseen(self, clean: DataFrame, as_of: int | None = None) -> DataFrame:
        """The rows whose id no kept snapshot has; only ``clean`` is shuffled. Null ids are unseen."""
        return clean.join(self.counts(as_of).hint("shuffle_hash"), "event_id", "left_anti")

    def drop(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
