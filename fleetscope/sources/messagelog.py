"""S1, S2, S9 without a broker: a partitioned message log as a Spark data source.

A topic is a folder of partitions, a partition a sequence of Parquet segments whose
names give the offsets they hold::

    <path>/<topic>/partition=<p>/<first offset>-<messages>.parquet

So all offsets follow from one listing, and a range of offsets is read from the
segments that overlap it, in Arrow batches. ``spark.read`` replays a bounded range,
``spark.readStream`` subscribes with offsets per partition that Spark keeps in its
checkpoint (the same JSON form as Kafka's), ``df.write`` publishes. A range
is cut into tasks of at most ``rowsPerTask`` messages, so one partition with most
of the messages is read by many tasks.

Options: ``path`` (any store that pyarrow opens), ``topic``, ``startingOffsets`` (earliest, latest or
JSON), ``endingOffsets`` (latest or JSON; batch), ``rowsPerTask``, ``partitions`` (of a new
topic; writing). One job writes to a topic at a time: segments are written under
hidden names and renamed, in order, when the job commits; of a failed job nothing is seen.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

FORMAT = "message_log"
SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))])
_STORED = pa.schema([_ARROW.field(c) for c in ("key", "value", "timestamp")])
ROWS_PER_TASK = 1 << 20
_SEGMENT = re.compile(r"/partition=(\d+)/(\d{20})-(\d{10})\.parquet$")


@dataclass(frozen=True)
class Segment:
    path: str
    partition: int
    first: int
    stop: int


class Topic:
    """The segments of a topic, as they are listed now."""

    def __init__(self, path: str, topic: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        self.topic = topic
        self.folder = f"{self.root.rstrip('/')}/{topic}"

    def segments(self) -> list[Segment]:
        found = self.fs.get_file_info(pafs.FileSelector(self.folder, recursive=True, allow_not_found=True))
        hits = [(f.path, m) for f in found if (m := _SEGMENT.search(f.path))]
        return sorted((Segment(p, int(m[1]), int(m[2]), int(m[2]) + int(m[3])) for p, m in hits),
                      key=lambda s: (s.partition, s.first))

    def bounds(self) -> dict[int, tuple[int, int]]:
        """(earliest, next) offset of each partition."""
        out: dict[int, tuple[int, int]] = {}
        for s in self.segments():
            out[s.partition] = (out[s.partition][0] if s.partition in out else s.first, s.stop)
        return out

    def heads(self) -> dict[str, int]:
        """The offset of the next message, by partition."""
        return {str(p): stop for p, (_, stop) in self.bounds().items()}

    def offsets(self, wanted: str) -> dict[str, int]:
        bounds = self.bounds()
        if wanted in ("earliest", "latest"):
            return {str(p): b[wanted == "latest"] for p, b in bounds.items()}
        named = json.loads(wanted).get(self.topic, {})
        # as Kafka's option has it: -2 is the earliest offset, -1 the latest
        return {p: bounds[int(p)][0] if o == -2 else bounds[int(p)][1] if o == -1 else o for p, o in named.items()}

    def ranges(self, start: dict[str, int], stop: dict[str, int], rows: int) -> list["Range"]:
        """The segments of the offsets from ``start`` to ``stop`` (exclusive) by task; partitions that
        ``start`` does not name begin at their first message."""
        by: dict[int, list[Segment]] = {}
        for s in self.segments():
            by.setdefault(s.partition, []).append(s)
        out = []
        for p, end in sorted(stop.items(), key=lambda x: int(x[0])):
            own = by.get(int(p), [])
            begin = start.get(p, own[0].first if own else 0)
            if begin >= end:
                continue
            if not own or own[0].first > begin or own[-1].stop < end:
                raise ValueError(f"offsets {begin} to {end} of {self.topic}-{p} are not all in the log")
            for low in range(begin, end, rows):
                high = min(end, low + rows)
                out.append(Range(int(p), low, high, [s for s in own if s.first < high and s.stop > low]))
        return out


class Range(InputPartition):
    """The offsets ``low`` to ``high`` of a partition, and the segments that hold them."""

    def __init__(self, partition: int, low: int, high: int, segments: list[Segment]):
        super().__init__(None)
        self.partition, self.low, self.high, self.segments = partition, low, high, segments


def _read(topic: Topic, part: Range | None):
    for s in part.segments if part else []:  # Spark reads a plan without partitions as one of None
        at = s.first
        with topic.fs.open_input_file(s.path) as f:
            for b in pq.ParquetFile(f).iter_batches(columns=_STORED.names):
                low, high = max(part.low - at, 0), min(part.high - at, b.num_rows)
                if low < high:
                    rows, n = b.slice(low, high - low), high - low
                    yield pa.RecordBatch.from_arrays([
                        rows.column(0), rows.column(1), pa.array([topic.topic] * n, pa.string()), pa.array([part.partition] * n, pa.int32()),
                        pa.array(range(at + low, at + high), pa.int64()), rows.column(2).cast(_ARROW.field("timestamp").type)], schema=_ARROW)
                at += b.num_rows


class LogReader(DataSourceReader):
    def __init__(self, options):
        self.topic = Topic(options["path"], options["topic"])
        self.start, self.stop = options.get("startingOffsets", "earliest"), options.get("endingOffsets", "latest")
        self.rows = int(options.get("rowsPerTask", ROWS_PER_TASK))

    def partitions(self):
        return self.topic.ranges(self.topic.offsets(self.start), self.topic.offsets(self.stop), self.rows)

    def read(self, partition):
        return _read(self.topic, partition)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are ``{topic: {partition: next offset}}``."""

    def __init__(self, options):
        self.topic = Topic(options["path"], options["topic"])
        self.start = options.get("startingOffsets", "earliest")
        self.rows = int(options.get("rowsPerTask", ROWS_PER_TASK))

    def initialOffset(self):
        return {self.topic.topic: self.topic.offsets(self.start)}

    def latestOffset(self):
        return {self.topic.topic: self.topic.heads()}

    def partitions(self, start, end):
        return self.topic.ranges(start.get(self.topic.topic, {}), end.get(self.topic.topic, {}), self.rows)

    def read(self, partition):
        return _read(self.topic, partition)


@dataclass
class Written(WriterCommitMessage):
    """(partition, hidden name, messages) of the segments of a task."""
    segments: list


class LogWriter(DataSourceArrowWriter):
    """Publishes ``value`` (text or bytes) with ``key`` and ``partition`` if the frame has them. Without a
    partition a message goes by the checksum of its key, without a key in turn."""

    def __init__(self, options):
        self.topic = Topic(options["path"], options["topic"])
        have = self.topic.bounds()
        self.n = max(have) + 1 if have else int(options.get("partitions", 4))

    def _partition_of(self, batch: pa.RecordBatch, turn: int) -> list[int]:
        if "partition" in batch.schema.names:
            return batch.column("partition").to_pylist()
        keys = batch.column("key").to_pylist() if "key" in batch.schema.names else [None] * batch.num_rows
        raw = lambda k: k.encode() if isinstance(k, str) else k
        return [(turn + i) % self.n if k is None else zlib.crc32(raw(k)) % self.n for i, k in enumerate(keys)]

    def write(self, iterator):
        from pyspark import TaskContext
        turn = TaskContext.get().partitionId()
        open_: dict[int, list] = {}
        now = pa.scalar(_now(), pa.timestamp("us", tz="UTC"))
        for b in iterator:
            named = b.schema.names
            key = b.column("key").cast(pa.binary()) if "key" in named else pa.nulls(b.num_rows, pa.binary())
            rows = pa.RecordBatch.from_arrays([key, b.column("value").cast(pa.binary()), pa.repeat(now, b.num_rows)], schema=_STORED)
            dealt = self._partition_of(b, turn)
            for p in sorted(set(dealt)):
                if p not in open_:
                    name = f"{self.topic.folder}/partition={p}/.{uuid.uuid4().hex}.tmp"
                    self.topic.fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    open_[p] = [name, pq.ParquetWriter(self.topic.fs.open_output_stream(name), _STORED, compression="zstd"), 0]
                own = rows.filter(pc.equal(pa.array(dealt), p))
                open_[p][1].write_batch(own)
                open_[p][2] += own.num_rows
            turn += b.num_rows
        for _, writer, _n in open_.values():
            writer.close()
        return Written([(p, name, n) for p, (name, _w, n) in sorted(open_.items())])

    def commit(self, messages):
        heads = self.topic.heads()
        for p, name, n in (s for m in messages if m for s in m.segments):
            first = heads.get(str(p), 0)
            self.topic.fs.move(name, f"{self.topic.folder}/partition={p}/{first:020d}-{n:010d}.parquet")
            heads[str(p)] = first + n

    def abort(self, messages):
        for _p, name, _n in (s for m in messages if m for s in m.segments):
            self.topic.fs.delete_file(name)


def _now():
    import datetime
    return datetime.datetime.now(datetime.timezone.utc)


class MessageLog(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LogReader(self.options)

    def streamReader(self, schema):
        return LogStreamReader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a log is only appended to")
        return LogWriter(self.options)


def register(spark: SparkSession) -> SparkSession:
    from fleetscope.session import ship_package
    ship_package(spark)
    spark.dataSource.register(MessageLog)
    return spark


def log_stream(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest", **options) -> DataFrame:
    """Subscribe to a topic of the log."""
    reader = register(spark).readStream.format(FORMAT).option("topic", topic).option("startingOffsets", starting_offsets)
    return reader.options(**options).load(path)


def log_replay(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest",
               ending_offsets: str = "latest", **options) -> DataFrame:
    """A bounded read from offset to offset."""
    reader = register(spark).read.format(FORMAT).option("topic", topic).option("startingOffsets", starting_offsets)
    return reader.option("endingOffsets", ending_offsets).options(**options).load(path)


def write_log(messages: DataFrame, path: str, topic: str, **options) -> None:
    """Publish frames of ``value`` (and ``key``, ``partition``)."""
    register(messages.sparkSession)
    kept = [c for c in ("key", "value", "partition") if c in messages.columns]
    messages.select(*kept).write.format(FORMAT).mode("append").option("topic", topic).options(**options).save(path)
