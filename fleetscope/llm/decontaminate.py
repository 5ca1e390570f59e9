"""Benchmark decontamination with an FM-index for each training shard.

The test phrases are the 10-word windows of the benchmark items (an item of
fewer words is one phrase). A shard is a few MB of documents inside one task.
Its words become symbols of the phrases' vocabulary; words that no phrase has
can be in no occurrence, so a stretch of them is one separator, and stretches
of vocabulary words shorter than the shortest phrase go too. Over what is
left the shard's FM-index is built: the Burrows-Wheeler transform of its suffix
array, kept as a wavelet matrix whose ranks drive the backward search of all
phrases at once. Occurrences are located by walking to the next sampled suffix
position, mapped to words of their documents and merged into removal spans.

Documents never move for the search: phrases are sent to them, in blocks of a
checked size (``PHRASE_BYTES``), one pass over the documents for each block;
as many passes as the benchmark needs. Only hits are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import written

WINDOW = 10
#: Bytes of phrases in a block: what a pass sends to every task.
PHRASE_BYTES = 8 << 20
#: Bytes of text in a shard.
SHARD_BYTES = 4 << 20
#: One suffix position in so many is kept.
SAMPLE = 8
# Word characters are 0-9, a-z and everything beyond ASCII; A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class WaveletMatrix:
    """Ranks over a sequence of small integers."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = []
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.concatenate(([0], np.cumsum(bit))).astype(np.int64)
            self.levels.append((shift, ones, len(seq) - ones[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def _down(self, at: np.ndarray, bits, ones, zeros) -> np.ndarray:
        one = ones[at]
        return np.where(bits, zeros + one, at - one)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low = np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            bits = (symbol >> shift) & 1 == 1
            at, low = self._down(at, bits, ones, zeros), self._down(low, bits, ones, zeros)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for _, ones, zeros in self.levels:
            bits = ones[at + 1] - ones[at]
            out = out * 2 + bits
            at = self._down(at, bits == 1, ones, zeros)
        return out


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of ranks by prefix doubling."""
    n, k = len(rank), 1
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


class FMIndex:
    """FM-index of stretches of symbols from 1 up, joined by separators (0)."""

    def __init__(self, seq: np.ndarray, top: int):
        # each separator sorts as a symbol of its own, so no suffix order crosses one
        seps = seq == 0
        n_sep = int(seps.sum())
        sa = suffix_array(np.where(seps, np.cumsum(seps) - 1, seq + n_sep))
        self.bwt = WaveletMatrix(seq[sa - 1], top)
        counts = np.bincount(seq, minlength=top + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        # stretch starts are sampled too: the walk never meets a separator
        kept = (sa % SAMPLE == 0) | seps[sa - 1]
        self.sampled = np.concatenate(([0], np.cumsum(kept)))
        self.positions = sa[kept]
        self.size = len(seq)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases of one length, a row each; empty: equal ends."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for symbol in phrases.T[::-1]:
            s = symbol[live].astype(np.int64)
            lo[live] = self.first[s] + self.bwt.rank(s, lo[live])
            hi[live] = self.first[s] + self.bwt.rank(s, hi[live])
            live = live[hi[live] > lo[live]]
        hi = np.maximum(lo, hi)
        dead = np.ones(len(phrases), bool)
        dead[live] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out = np.zeros(len(rows), np.int64)
        todo, steps, at = np.arange(len(rows)), 0, rows.copy()
        while len(todo):
            kept = self.sampled[at + 1] > self.sampled[at]
            out[todo[kept]] = self.positions[self.sampled[at[kept]]] + steps
            todo, at = todo[~kept], at[~kept]
            s = self.bwt.access(at)
            at = self.first[s] + self.bwt.rank(s, at)
            steps += 1
        return out


class Phrases:
    """A block of phrases: [(id, words)], words joined by a space."""

    def __init__(self, block: list[tuple[int, bytes]]):
        split = [(i, p.split(b" ")) for i, p in block]
        vocabulary = sorted({w for _, p in split for w in p})
        self.symbol = {w: i for i, w in enumerate(vocabulary, 1)}
        self.top = len(vocabulary)
        by: dict[int, list] = {}
        for i, p in split:
            by.setdefault(len(p), []).append((i, [self.symbol[w] for w in p]))
        self.by_length = {n: (np.array([i for i, _ in v], np.int64), np.array([p for _, p in v], np.int64))
                          for n, v in by.items()}
        self.shortest = min(by, default=0)

    def hits(self, docs: list[list[bytes]]) -> Iterator[tuple[int, int, int, int]]:
        """(document, word, length, phrase id) of every occurrence in a shard."""
        if not self.by_length:
            return
        get = self.symbol.get
        lengths = np.array([len(d) + 1 for d in docs])
        text = np.zeros(int(lengths.sum()), np.int64)
        ends = np.cumsum(lengths)
        for d, end in zip(docs, ends.tolist()):
            if d:
                text[end - 1 - len(d):end - 1] = [get(w, 0) for w in d]
        # stretches of vocabulary words that are long enough, one separator after each
        known = np.concatenate(([0], text > 0, [0])).astype(np.int8)
        change = np.flatnonzero(np.diff(known))
        start, stop = change[::2], change[1::2]
        long = stop - start >= self.shortest
        start, stop = start[long], stop[long]
        if not len(start):
            return
        sizes = stop - start + 1
        heads = np.cumsum(sizes) - sizes
        origin = np.repeat(start - heads, sizes) + np.arange(int(sizes.sum()))
        index = FMIndex(np.where(np.arange(len(origin)) - np.repeat(heads, sizes) + 1 == np.repeat(sizes, sizes),
                                 0, text[np.minimum(origin, len(text) - 1)]), self.top)
        for n, (ids, phrases) in self.by_length.items():
            lo, hi = index.search(phrases)
            count = hi - lo
            rows = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            at = origin[index.locate(rows)]
            doc = np.searchsorted(ends, at, side="right")
            first = ends[doc] - lengths[doc]
            yield from zip(doc.tolist(), (at - first).tolist(), [n] * len(at), np.repeat(ids, count).tolist())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def phrases_of(benchmark: DataFrame, item: str = "item_id", text: str = "text",
               window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(phrase_id, phrase binary, block) and (phrase_id, item): the distinct
    windows of the items. Items without words have none; null item ids are
    searched for but not named."""
    kind = benchmark.schema[item].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(t)
                grams = {b" ".join(w[k:k + window]) for k in range(max(1, len(w) - window + 1))} if w else ()
                ids += [i] * len(grams)
                out += grams
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(out, pa.binary())],
                                             ["item", "phrase"])
    grams = written(benchmark.select(item, F.encode(F.col(text).cast("string"), "UTF-8").alias("text"))
                    .mapInArrow(run, f"item {kind}, phrase binary"), "benchmark-windows")
    phrases = grams.groupBy("phrase").agg(F.count("*").alias("n")).select(
        F.monotonically_increasing_id().alias("phrase_id"), "phrase")
    size = phrases.agg(F.sum(F.length("phrase") + 32)).first()[0] or 0
    blocks = max(1, -(-size // PHRASE_BYTES))
    phrases = written(phrases.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks)).cast("int")),
                      "phrases")
    items = grams.where("item is not null").distinct().join(phrases, "phrase").select("phrase_id", "item")
    return phrases, items


def spans(df: DataFrame, phrases: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``df``: key, digest (SHA-256 of the text, binary), n_words,
    spans (merged word ranges, array of (start, stop)) and phrase_ids (those that occur).

    A null text has no words. Null keys and repeated rows are kept."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.encode(F.col(text).cast("string"), "UTF-8").alias("text"))
    rows = rows.select("key", F.unhex(F.sha2(F.coalesce("text", F.lit(b"")), 256)).alias("digest"), "text")
    blocks = [r[0] for r in phrases.select("block").distinct().orderBy("block").collect()] or [0]
    parts = []
    for block in blocks:  # each is at most about PHRASE_BYTES
        chosen = phrases.where(F.col("block") == block).select("phrase_id", "phrase").collect()
        sent = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in chosen])

        def run(batches, sent=sent):
            searched = Phrases(sent.value)
            for b in batches:
                sizes = b.column(2).fill_null(b"")
                sizes = np.cumsum([len(x) for x in sizes.to_pylist()])
                cuts = np.flatnonzero(np.diff(sizes // SHARD_BYTES, prepend=0)).tolist()
                for i, j in zip([0, *cuts], [*cuts, b.num_rows]):
                    if i < j:
                        yield _shard(b.slice(i, j - i), searched)
        parts.append(rows.mapInArrow(
            run, f"key {kind}, digest binary, n_words long, spans array<struct<start:int,stop:int>>,"
                 " phrase_ids array<long>").withColumn("block", F.lit(block)))
    if len(parts) == 1:
        return parts[0].drop("block").withColumnRenamed("key", key)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # equal rows have equal hits: one of them for each block, then all blocks together
    one = every.groupBy("key", "digest", "block").agg(
        F.count("*").alias("m"), F.first("n_words").alias("n_words"), F.first("spans").alias("spans"),
        F.first("phrase_ids").alias("phrase_ids"))
    whole = one.groupBy("key", "digest").agg(
        F.first("m").alias("m"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("phrase_ids")))).alias("phrase_ids"))
    return whole.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).select(
        F.col("key").alias(key), "digest", "n_words", _joined("spans").alias("spans"), "phrase_ids")


def _joined(column: str):
    """Overlapping ranges of a sorted array become one."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        return (F.when(F.size(acc) == 0, F.array(x))
                .when(x.start <= last.stop, F.concat(
                    F.slice(acc, 1, F.size(acc) - 1),
                    F.array(F.struct(last.start.alias("start"), F.greatest(last.stop, x.stop).alias("stop")))))
                .otherwise(F.concat(acc, F.array(x))))
    return F.aggregate(column, none, step)


def _shard(batch: pa.RecordBatch, searched: Phrases) -> pa.RecordBatch:
    docs = [words(t) for t in batch.column(2).to_pylist()]
    found: dict[int, tuple[list, set]] = {}
    for doc, at, n, phrase in searched.hits(docs):
        ranges, ids = found.setdefault(doc, ([], set()))
        ranges.append((at, at + n))
        ids.add(phrase)
    ranges = [merged(found[i][0]) if i in found else [] for i in range(len(docs))]
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array([len(d) for d in docs], pa.int64()),
         pa.array([[{"start": a, "stop": b} for a, b in r] for r in ranges], pa.list_(span)),
         pa.array([sorted(found[i][1]) if i in found else [] for i in range(len(docs))], pa.list_(pa.int64()))],
        ["key", "digest", "n_words", "spans", "phrase_ids"])


def report(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each row: key, n_words, n_hit, spans, items (sorted item ids as
    strings whose windows occur). Null texts have no words; an empty benchmark
    hits nothing; null keys and repeated rows are kept."""
    phrases, items = phrases_of(benchmark, item, item_text)
    found = written(spans(df, phrases, key, text), "hits")
    # documents with the same phrases (copies, a shared passage) are one set: its items are named once
    sets = found.where("size(phrase_ids) > 0").select("phrase_ids").distinct()
    named = (sets.select("phrase_ids", F.explode("phrase_ids").alias("phrase_id")).join(items, "phrase_id")
             .groupBy("phrase_ids").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x.stop - x.start))
    none = F.array().cast("array<string>")
    # rows without a phrase, nearly all, need no names and take no part in the join
    hit = found.where("size(phrase_ids) > 0").join(named, "phrase_ids", "left")
    rows = found.where("size(phrase_ids) = 0").withColumn("items", none).unionByName(hit)
    return rows.select(key, "n_words", n_hit.alias("n_hit"), "spans", F.coalesce("items", none).alias("items"))


def cut(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the ranges and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in ranges:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]])


def remove(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the removal spans cut from its texts; rows without a hit are
    returned as they are, all rows and columns stay."""
    phrases, _ = phrases_of(benchmark)
    hit = (written(spans(df, phrases, key, text).where("size(spans) > 0").select("digest", "spans"), "removals")
           .groupBy("digest").agg(F.first("spans").alias("__spans")).withColumnRenamed("digest", "__digest"))
    columns = df.columns
    raw = F.encode(F.col(text).cast("string"), "UTF-8")
    rows = df.withColumn("__digest", F.unhex(F.sha2(F.coalesce(raw, F.lit(b"")), 256)))
    joined = rows.join(hit.hint("shuffle_hash"), "__digest", "left")

    def run(batches):
        at = columns.index(text)
        for b in batches:
            out = [t if s is None else cut(t.encode(), [(x["start"], x["stop"]) for x in s]).decode()
                   for t, s in zip(b.column(at).to_pylist(), b.column(len(columns)).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, b.schema.field(at).type) if i == at else b.column(i) for i in range(len(columns))],
                schema=pa.schema([b.schema.field(i) for i in range(len(columns))]))
    return joined.select(*[F.col(c) for c in columns], "__spans").mapInArrow(run, df.schema)
