"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at
most three bits differ in at most three bytes, so they share at least five of
the eight: the guaranteed minimum. The index is keyed by positional bytes,
three at a time: of any five positions, three lie in the same half, so two
such fingerprints meet under at least one of the eight triples that the halves
hold (four each). A single byte would list one in 256 of all fingerprints
under a key; a triple lists one in 16.8 million. In each posting list the
shared positional bytes are tallied for each pair, pairs below the minimum are
dropped, and the rest are verified by their differing bits.

Equal fingerprints are one member, so copies never meet. Long posting lists
are compared in blocks (see ``blocks``) and yield stars of connected members,
not pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.blocks import compared, forest
from fleetscope.llm.common import written
from fleetscope.llm.components import components

SEED = 42
BYTES = 8
#: Members of a block.
BLOCK = 1024
#: Shingles whose bits are tallied at a time.
TALLY = 1 << 15
_TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]


def fingerprint(text: str | None, shingle: int) -> int:
    """Lower-cases A-Z, takes words of anything but ASCII white space and
    shingles of ``shingle`` words, repeats included (fewer words: the whole
    sequence); a bit is 1 if it is set in over half of the XXH64 values. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    stops = ends[-n:] - 1
    starts = np.concatenate(([0], ends[:n - 1]))
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(joined[i:j], SEED) for i, j in zip(starts.tolist(), stops.tolist())], np.uint64)
    tally = np.zeros(64, np.int64)
    for at in range(0, n, TALLY):
        bits = np.unpackbits(hashes[at:at + TALLY].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        tally += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(tally * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp bigint) for each row; a null text has no words."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], [key, "fp"])
    return df.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, fp long")


def _links(max_bits: int):
    least = BYTES - max_bits

    def unit(table: pa.Table) -> pa.RecordBatch | None:
        fps = table.column("fp").to_numpy().view(np.uint64)
        if len(fps) <= 4:
            pairs = [(a, b) for a, b in combinations(fps.tolist(), 2)
                     if sum(not (a ^ b) >> 8 * i & 255 for i in range(BYTES)) >= least
                     and (a ^ b).bit_count() <= max_bits]
            found = np.array(pairs, np.uint64).reshape(-1, 2)
        else:
            own = fps.view(np.uint8).reshape(-1, BYTES)
            shared = np.zeros((len(fps), len(fps)), np.uint8)
            for p in range(BYTES):
                shared += own[:, p, None] == own[None, :, p]
            x, y = np.nonzero(shared >= least)
            near = np.bitwise_count(fps[x] ^ fps[y]) <= max_bits
            linked = np.zeros(shared.shape, bool)
            linked[x[near], y[near]] = True
            np.fill_diagonal(linked, False)
            found = fps[np.array(forest(linked), np.int64).reshape(-1, 2)]
        if not len(found):
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, i]).view(np.int64))
                                           for i in (0, 1)], ["a", "b"])
    return unit


def links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) that connect what links among the distinct fingerprints ``classes.fp``.

    ``max_bits`` up to 3: beyond that the triples no longer meet every pair."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index meets every pair up to 3 differing bits")
    byte = lambda i: F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))
    keys = F.array(*[sum((byte(p) * (1 << 8 * i) for i, p in enumerate(t)), F.lit(j << 24).cast("long"))
                     for j, t in enumerate(_TRIPLES)])
    postings = classes.select("fp", F.explode(keys).alias("bytes"))
    return compared(postings, ["bytes"], "fp", BLOCK, "a long, b long", _links(max_bits))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(key, fp, component_id) for each row: component_id is the smallest key
    that can be reached over fingerprints with at most ``max_bits`` differing
    bits, the row itself included.

    Null and empty texts share fingerprint zero and so one component. Repeated
    rows and null keys are kept; nulls never are the smallest key unless a
    component has no other. Other columns are ignored. Empty in, empty out.
    """
    docs = written(fingerprints(df, key, text, shingle), "fingerprints")
    classes = docs.groupBy("fp").agg(F.min(key).alias("rep"))
    roots = components(links(classes, max_bits))
    named = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return docs.join(named.join(least, "root").select("fp", "component_id"), "fp").select(
        key, "fp", "component_id")
