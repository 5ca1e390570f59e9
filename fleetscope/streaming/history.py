"""H3 + V11 over time: the counts and the lag of every batch of a stream, kept in the store.

A listener on Spark's own progress events adds one small file for each batch to
``<root>/_ingest/day=<d>/``: rows read, valid and rejected rows, rejections by rule (as the
processor has observed them) and, for sources with offsets, the latest and the committed
offset of every partition. A replayed batch adds a second row; readers
take a batch's last one.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from fleetscope.operators.health import lag_rows
from fleetscope.sources.store import _exists

FOLDER = "_ingest"
SCHEMA = ("stream string, batch_id long, at timestamp, input_rows long, valid long, rejected long, rules map<string,long>, "
          "lag array<struct<topic:string,partition:int,latest_offset:long,committed_offset:long>>")


class IngestHistory(StreamingQueryListener):
    """Appends a row for each batch of ``processor``'s stream that has read anything."""

    def __init__(self, spark: SparkSession, processor):
        self.spark, self.processor = spark, processor
        self.streams: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        counts = self.processor.last_counts.get(p.batchId)
        if not p.numInputRows or counts is None:
            return
        sources = [{"endOffset": s.endOffset, "latestOffset": s.latestOffset} for s in p.sources]
        append(self.spark, self.processor.root, str(p.id), p.batchId, counts,
               self.processor.rejections.get(p.batchId, {}), lag_rows({"sources": sources}))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def append(spark: SparkSession, root: str, stream: str, batch_id: int, counts: tuple[int, int],
           rules: Mapping[str, int], lag: list[tuple]) -> None:
    now = _dt.datetime.now(_dt.timezone.utc)
    row = spark.createDataFrame([(stream, batch_id, now, sum(counts), *counts, dict(rules), lag)], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(os.path.join(root, FOLDER, f"day={now:%Y-%m-%d}"))


def ingest_history(spark: SparkSession, root: str) -> DataFrame:
    """All rows that were kept, with their ``day``."""
    path = os.path.join(root, FOLDER)
    if not _exists(spark, path):
        return spark.createDataFrame([], SCHEMA + ", day date")
    return spark.read.schema(SCHEMA + ", day date").parquet(path)
