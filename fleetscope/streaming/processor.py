"""The stream job -- decode, validate, route, two sinks per micro-batch.

The batch body is the same pure ``validate(decode(df))`` used by the batch
queries, so stream output equals batch output by construction. No row goes
to the driver: the micro-batch is persisted once (its size is bounded by the
trigger: ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``), both sides are
filtered from it and written to their snapshot directories, and one manifest row for
both goes last (see fleetscope.sources.store). The accounting -- valid and rejected
rows, rejections by rule -- is observed while the batch passes, without a job of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetscope.functions.rules import default_rules
from fleetscope.operators import validate as V
from fleetscope.session import prepare
from fleetscope.sources import store
from fleetscope.sources.messages import decode


class TelemetryProcessor:
    """foreachBatch sink writing clean events and dead letters per batch.

    A batch is known by (stream, batch id). ``stream`` is the id that Spark keeps
    in the query's checkpoint: a restart goes on under it, a new checkpoint has a
    new one, and its batches, which count from 0 again, replace nothing.

    ``last_counts`` and ``rejections`` hold what was observed in the latest ``KEPT`` batches, by
    batch id: (valid, rejected) rows, and rejected rows by rule.
    """

    KEPT = 64

    def __init__(self, root: str, rules: Sequence[tuple[str, Column]] | None = None):
        self.root = root
        self.stream = "manual"
        self.rules = rules
        self.last_counts: dict[int, tuple[int, int]] = {}
        self.rejections: dict[int, dict[str, int]] = {}
        #: Stream and snapshot of the batch before: the numbers up to it need no second look.
        self._before: tuple[str, int] | None = None

    def _stream_id(self, spark) -> str:
        return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or self.stream

    def _snapshot(self, spark, stream: str, batch_id: int) -> int:
        known = self._before[1] if self._before and self._before[0] == stream and batch_id not in self.last_counts else None
        return store.snapshot_for(spark, self.root, f"{stream}/{batch_id}", known)

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """T1 body; V12: an empty batch writes nothing."""
        if batch.isEmpty():
            return
        spark = prepare(batch.sparkSession)
        stream = self._stream_id(spark)
        snapshot = self._snapshot(spark, stream, batch_id)
        names = [name for name, _ in (self.rules if self.rules is not None else default_rules())]
        seen = Observation()
        validated = V.validate(decode(batch.select("value")), self.rules).observe(
            seen, F.count_if(V.is_valid()).alias("valid"), F.count_if(~V.is_valid()).alias("rejected"),
            *[F.count(F.col("reasons")[i]).alias(f"rule {i}") for i in range(len(names))])
        validated = validated.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stamp = F.current_timestamp()  # V8: audit stamps only in the sink
            sides = {"clean_events": V.clean_side(validated).withColumn("processed_at", stamp),
                     "dead_letter": V.dead_side(validated).withColumn("rejected_at", stamp)}
            store.write_batch(sides, self.root, snapshot, lambda: dict(zip(sides, self._observed(seen))), f"{stream}/{batch_id}")
            self.last_counts[batch_id] = self._observed(seen)
            self.rejections[batch_id] = {name: seen.get[f"rule {i}"] for i, name in enumerate(names)}
            self._before = (stream, snapshot)
            for held in (self.last_counts, self.rejections):
                while len(held) > self.KEPT:
                    del held[min(held)]
        finally:
            validated.unpersist()

    @staticmethod
    def _observed(seen: Observation) -> tuple[int, int]:
        return seen.get["valid"], seen.get["rejected"]

    def start(self, source: DataFrame, checkpoint: str, processing_time: str | None = "10 seconds",
              available_now: bool = False, name: str | None = None, history: bool = False) -> StreamingQuery:
        """T2 + T3: trigger every ``processing_time`` (or drain what is
        available and stop), offsets checkpointed under ``checkpoint``. ``history``: append
        every batch's counts and lag to the store (see fleetscope.streaming.history)."""
        store.ensure_tables(source.sparkSession, self.root)
        if history:
            from fleetscope.streaming.history import IngestHistory
            source.sparkSession.streams.addListener(IngestHistory(source.sparkSession, self))
        w = (source.writeStream.foreachBatch(self.process_batch)
             .option("checkpointLocation", checkpoint))
        if name:
            w = w.queryName(name)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        return w.start()


def stop(query: StreamingQuery, timeout_s: float = 30.0) -> None:
    """T5: let the current batch finish, then stop."""
    try:
        query.awaitTermination(timeout_s)
    finally:
        if query.isActive:
            query.stop()
