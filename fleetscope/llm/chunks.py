"""Questions from chunks of documents to tables that are partitioned by hash.

Documents are staged once as chunks: consecutive rows of a task, up to
``CHUNK_BYTES`` of text, in a table bucketed by chunk in the shared folder. A
chunk asks about its distinct items: for each hash bucket it packs what it asks
into one row. A bucket's group answers every chunk in the order it was asked,
and the chunk, read again from the staged table without a shuffle, applies the
answers. So only packed questions and answers cross the network, never rows
for single items, and an item that a third of all documents hold is asked about
once by each chunk: no bucket grows with the copies of an item.

Memory: a task holds one chunk, or the questions of one bucket. There are as many
buckets as there are chunks' worths of text (and at least as many as shuffle
partitions), so neither grows with the data. ``chunk_bytes`` is the one size to
choose: the packed rows number chunks x buckets, so it should grow with the square root of the
data; 6 MB suit some 100 GB, 128 MB suit 100 TB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import shared_path, written

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 6 << 20


def staged(df: DataFrame, key: str, text: str, chunk_bytes: int | None = None) -> tuple[DataFrame, int]:
    """(chunk, key, text binary), and the number of hash buckets for its items.

    Null texts are empty; rows and nulls of the key stay."""
    chunk_bytes = chunk_bytes or CHUNK_BYTES
    spark = df.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        first, seq, size = TaskContext.get().partitionId() << 24, 0, 0
        for b in batches:
            lengths = np.array([len(x) for x in b.column(1).to_pylist()], np.int64)
            chunk = np.empty(len(lengths), np.int64)
            for i, n in enumerate(lengths.tolist()):
                if size and size + n > chunk_bytes:
                    seq, size = seq + 1, 0
                size += n
                chunk[i] = first + seq
            yield pa.RecordBatch.from_arrays([pa.array(chunk), b.column(0), b.column(1), pa.array(lengths)],
                                             ["chunk", "key", "text", "size"])

    rows = df.select(F.col(key).alias("key"),
                     F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8").alias("text"))
    name = f"staged_{uuid.uuid4().hex}"
    (rows.mapInArrow(run, f"chunk long, key {kind}, text binary, size long")
     .write.bucketBy(partitions, "chunk").option("compression", "zstd").option("path", shared_path(spark, "staged"))
     .saveAsTable(name))
    table = spark.table(name)
    size = table.agg(F.sum("size")).first()[0] or 0
    return table.drop("size"), max(partitions, -(-size // chunk_bytes))


def _questions(run: Callable, *sides: DataFrame) -> DataFrame:
    """(chunk, bucket, ask) rows that ``run(docs, answers)`` gives for each chunk."""
    def asked(*args):
        docs, answers = args[0], args[1] if len(args) > 1 else None
        chunk = docs.column("chunk")[0].as_py() if docs.num_rows else None
        found = run(docs, _by_bucket(answers)) if docs.num_rows else {}
        return pa.table({"chunk": pa.array([chunk] * len(found), pa.int64()),
                         "bucket": pa.array(list(found), pa.int32()),
                         "ask": pa.array(list(found.values()), pa.binary())})
    return _each(asked, "chunk long, bucket int, ask binary", *sides)


def _each(fn: Callable, schema: str, docs: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    if answers is None:
        return docs.groupBy("chunk").applyInArrow(lambda t: fn(t), schema)
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda t, a: fn(t, a), schema)


def _by_bucket(answers: pa.Table | None) -> dict[tuple[int, int], bytes]:
    if answers is None:
        return {}
    return dict(zip(zip(answers.column("phase").to_pylist(), answers.column("bucket").to_pylist()),
                    answers.column("answer").to_pylist()))


def asked(docs: DataFrame, ask: Callable, answer: Callable, phase: int,
          before: DataFrame | None = None) -> DataFrame:
    """One round of questions; (chunk, phase, bucket, answer), written to the shared folder.

    ``ask(docs, answers)``: packed questions by bucket, from a chunk's table and
    the answers of earlier rounds by (phase, bucket). ``answer(list of questions)``:
    as many answers, for one bucket. ``before``: answers of earlier rounds."""
    questions = _questions(ask, docs, before) if before is not None else _questions(ask, docs)

    def run(table):
        replies = answer(table.column("ask").to_pylist())
        return pa.table({"chunk": table.column("chunk"),
                         "phase": pa.array([phase] * table.num_rows, pa.int32()), "bucket": table.column("bucket"),
                         "answer": pa.array(replies, pa.binary())})
    replies = questions.groupBy("bucket").applyInArrow(
        lambda t: run(t), "chunk long, phase int, bucket int, answer binary")
    return written(replies, "answers")


def applied(docs: DataFrame, answers: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(docs, answers by (phase, bucket))`` for each chunk, as a table of ``schema``."""
    def run(t, a):
        return fn(t, _by_bucket(a)) if t.num_rows else pa.table({"x": []})
    return _each(run, schema, docs, answers)


class Dealt:
    """The distinct items of a chunk, dealt to buckets by their hash.

    ``values``: sorted distinct numbers (the hash with the bucket taken out), by
    bucket; ``of``: for each bucket the places of its items; ``item``: for each
    input hash the place of its item."""

    def __init__(self, hashes: np.ndarray, n: int, bits: int = 64):
        distinct, self.item = np.unique(hashes, return_inverse=True)
        self.n_items = len(distinct)
        bucket = (distinct & np.uint64(0xFFFFFF)) % np.uint64(n)
        value = distinct >> np.uint64(24) if bits == 40 else distinct
        order = np.lexsort((value, bucket))
        cuts = np.searchsorted(bucket[order], np.arange(n + 1, dtype=np.uint64))
        self.of = {b: order[i:j] for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if j > i}
        self.values = {b: value[i] for b, i in self.of.items()}

    def gathered(self, parts: dict[int, np.ndarray], dtype) -> np.ndarray:
        """Answers by bucket, put in the order of the items."""
        out = np.zeros(self.n_items, dtype)
        for b, places in self.of.items():
            out[places] = parts[b]
        return out


def frame(*parts: bytes) -> bytes:
    """Byte strings in one, each after its length."""
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def unframe(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 4], "little")
        out.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return out
