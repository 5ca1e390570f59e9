"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period p, of ``least`` and
of 2 * p words at least, that no neighbouring word extends. Its last square ends
where the period breaks: the two suffixes that start the square and its second
half have a common prefix of exactly p words, so they lie in different children
of the interval of depth p.

The texts of a task are analysed some ``PIECE_WORDS`` words at a time, in one buffer
where every text ends in a code of its own, so that nothing matches across texts.
Prefix doubling gives the suffix array, its inverse (ISA) and the classes of equal
1, 2, 4, ... words, by which common prefixes are measured. A scan with a stack
finds for each entry of the LCP array how far its interval reaches on both
sides (equal entries are split one after another, so an interval of many children
is a chain of two-sided ones); no tree nodes are kept. Each suffix i of the
smaller side is tested: does ISA[i + depth] or ISA[i - depth] lie in the other
side? The squares found are rotated to the left as far as the period holds, again by
the classes, and those of one stretch are merged under their smallest period.

Row-local: nothing is shuffled. Memory: one piece, or one longer text, at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
#: Words analysed together; a longer text is a piece of its own.
PIECE_WORDS = 1 << 18
#: Suffixes tested at a time.
TESTED = 1 << 21


class SuffixArray:
    """Enhanced suffix array of a code sequence whose last code occurs once."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        order = np.argsort(codes, kind="stable")
        places, found, key = np.arange(n), order, codes[order]
        rank = np.empty(n, np.int32)
        #: rank[t][i]: the class of the 2**t codes from i; the last one is the inverse suffix array
        self.rank: list[np.ndarray] = []
        step = 0
        while True:
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            rank = rank.copy()
            rank[found] = np.repeat(places[first], size)
            self.rank.append(rank)
            many = np.repeat(size > 1, size)
            if not many.any():
                break
            step = step * 2 or 1
            places, found = places[many], found[many]
            key = rank[found].astype(np.int64) * n + rank[found + step]
            by = np.argsort(key, kind="stable")
            found, key = found[by], key[by]
            order[places] = found
        self.order, self.place = order, rank
        #: lcp[k]: of the suffixes at k - 1 and k
        self.lcp = np.zeros(n, np.int64)
        near = 1 + np.flatnonzero(self.rank[0][order[1:]] == self.rank[0][order[:-1]])
        self.lcp[near] = self.common(order[near - 1], order[near])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of different suffixes."""
        size = np.zeros(len(i), np.int64)
        for t in range(len(self.rank) - 2, -1, -1):
            same = self.rank[t][i + size] == self.rank[t][j + size]
            size[same] += 1 << t
        return size

    def rotated(self, i: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The first start from which ``period`` holds up to ``i``."""
        i = i.copy()
        for t in range(len(self.rank) - 2, -1, -1):
            back = i - (1 << t)
            same = back >= 0
            same[same] = self.rank[t][back[same]] == self.rank[t][back[same] + period[same]]
            i[same] = back[same]
        return i

    def sides(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(k, left, right) for each lcp[k] > 0: the suffixes at left..k-1 and those
        at k..right-1 share lcp[k] codes, and no more across the two sides."""
        lcp = self.lcp.tolist()
        n = len(lcp)
        left, right, stack = [0] * n, [n] * n, [0]
        lcp[0] = -1
        for k in range(1, n):
            depth = lcp[k]
            while lcp[stack[-1]] >= depth:
                right[stack.pop()] = k
            left[k] = stack[-1]
            stack.append(k)
        k = np.flatnonzero(self.lcp > 0)
        return k, np.array(left, np.int64)[k], np.array(right, np.int64)[k]

    def squares(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, period) of the branching tandem repeats, each once."""
        k, left, right = self.sides()
        small_left = k - left <= right - k
        start, size = np.where(small_left, left, k), np.minimum(k - left, right - k)
        low, high = np.where(small_left, k, left), np.where(small_left, right, k)
        starts, periods = [], []
        upto = np.cumsum(size)
        at = 0
        while at < len(k):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + TESTED)))
            node = np.repeat(np.arange(at, to), size[at:to])
            i = self.order[start[node] + np.arange(len(node)) - np.repeat(upto[at:to] - size[at:to] - (upto[at] - size[at]), size[at:to])]
            depth = self.lcp[k[node]]
            ahead = self.place[i + depth]
            hit = (ahead >= low[node]) & (ahead < high[node])
            starts.append(i[hit])
            periods.append(depth[hit])
            behind = i - depth
            within = behind >= 0
            i, depth, node = behind[within], depth[within], node[within]
            hit = (self.place[i] >= low[node]) & (self.place[i] < high[node])
            starts.append(i[hit])
            periods.append(depth[hit])
            at = to
        none = [np.zeros(0, np.int64)]
        return np.concatenate(starts or none).astype(np.int64), np.concatenate(periods or none)


def runs(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) rows of the runs, by start, then period. Texts in
    ``codes`` are told apart by final codes that occur once."""
    if len(codes) < 2:
        return np.zeros((0, 3), np.int64)
    suffixes = SuffixArray(codes)
    start, period = suffixes.squares()
    stop = start + 2 * period
    start = suffixes.rotated(start, period)
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    # a multiple of the smallest period gives the same stretch
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))) if len(start) else []
    found = np.stack([start, stop - start, period], axis=1)[np.asarray(first, bool)]
    found = found[found[:, 1] >= least]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _pieces(texts: list[list[bytes]], least: int):
    """Numbers of the texts to analyse together; shorter ones hold no run."""
    piece, size = [], 0
    for d, words in enumerate(texts):
        if len(words) < max(2, least):
            continue
        if piece and size + len(words) > PIECE_WORDS:
            yield piece
            piece, size = [], 0
        piece.append(d)
        size += len(words) + 1
    if piece:
        yield piece


def _analysed(texts: list[list[bytes]], least: int) -> dict[int, np.ndarray]:
    """The runs of each text that has any, by its number."""
    out = {}
    for piece in _pieces(texts, least):
        codes, heads, base = [], [], 0
        for d in piece:
            seen: dict[bytes, int] = {}
            codes.append(np.array([seen.setdefault(w, len(seen)) for w in texts[d]] + [len(seen)], np.int64) + base)
            heads.append(len(codes[-1]))
            base += len(seen) + 1
        heads = np.cumsum([0, *heads])
        found = runs(np.concatenate(codes), least)
        of = np.searchsorted(heads, found[:, 0], side="right") - 1
        found[:, 0] -= heads[of]
        cuts = np.flatnonzero(np.diff(of)) + 1
        for part, own in zip(np.split(found, cuts), np.split(of, cuts)):
            if len(own):
                out[piece[own[0]]] = part
    return out


def _collapsed(words: list[bytes], found: np.ndarray | None) -> bytes:
    if found is None:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return b" ".join([w for w, n in zip(words, np.cumsum(gone).tolist()) if not n])


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row for each row of ``df``: key, n_words, runs (start, length, period, by
    start, then period; words from 0) and collapsed: the words that no run
    contains after its first period, joined by one space.

    Words are separated by ASCII white space. Null and empty texts have no words.
    Null keys and repeated rows are kept; ties need no rule, for a text alone
    decides its runs. Other columns are ignored; an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def analyse(batches):
        for b in batches:
            texts = [(t or b"").split() for t in b.column(1).to_pylist()]
            found = _analysed(texts, least)
            each = [found.get(d) for d in range(len(texts))]
            sizes = np.array([0 if f is None else len(f) for f in each], np.int32)
            flat = np.concatenate([np.zeros((0, 3), np.int64), *[f for f in each if f is not None]])
            values = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(run))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values),
                 pa.array([_collapsed(w, f) for w, f in zip(texts, each)], pa.binary())],
                ["key", "n_words", "runs", "collapsed"])

    rows = df.select(F.col(key).alias("key"), F.encode(F.col(text).cast("string"), "UTF-8").alias("text"))
    out = rows.mapInArrow(analyse, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.select(F.col("key").alias(key), "n_words", "runs", F.decode("collapsed", "UTF-8").alias("collapsed"))
