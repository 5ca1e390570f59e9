"""Substring deduplication with fixed-block anchors.

The documents are cut into non-overlapping blocks of ``BLOCK`` words from their
start: the index. Every rolling window of that many words probes it. Any
repeated window of ``WINDOW`` >= 2 * BLOCK words holds a whole block in each of
its places, and that block is met by a probe in every other place; so only
windows that hold a probe which hits a block elsewhere can repeat. Those hits
are extended: the windows around them are compared by a 128-bit hash of their
words and joined to maximal runs.

Index and probes meet in hash buckets (see ``chunks``): a probe is five bytes
less what packing saves, an answer one bit. A hash that fits by chance only adds
a candidate. A candidate window is asked about once by each chunk that holds it, with
the smallest document there; the answer is one bit: whether a smaller document
has it elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from fleetscope.llm import chunks
from fleetscope.llm.rolling import Words, pack, pack_any, slice_hashes, unpack, unpack_any

WINDOW = 20
BLOCK = 10
_LAST = np.iinfo(np.int64).max


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Integer ids; nulls are larger than all."""
    return np.array([_LAST if x is None else x for x in column.to_pylist()], np.int64)


def _probes(words: Words, block: int, n: int) -> tuple[np.ndarray, chunks.Dealt]:
    """Starts of the rolling windows, and their hashes dealt to buckets."""
    at = words.windows(block)
    hashes = slice_hashes(words.data, words.starts[at], words.stops[at + block - 1])
    return at, chunks.Dealt(hashes, n, bits=40)


def _flags(words: Words, at: np.ndarray, dealt: chunks.Dealt, block: int) -> np.ndarray:
    """For each item: 1 if one of its places is a block, 2 if it has several places."""
    aligned = (at - words.first[words.doc[at]]) % block == 0
    out = (np.bincount(dealt.item, minlength=dealt.n_items) > 1) * np.uint8(2)
    out[dealt.item[aligned]] |= 1
    return out


def _meet(asks: list[bytes]) -> list[bytes]:
    """One bit for each probe: it has several places, and one of them is a block."""
    parts = [chunks.unframe(a) for a in asks]
    values = [unpack(p[0]) for p in parts]
    flags = [np.frombuffer(p[1], np.uint8) for p in parts]
    every, item = np.unique(np.concatenate(values), return_inverse=True)
    flag = np.concatenate(flags)
    places = np.bincount(item, weights=1 + (flag >> 1), minlength=len(every))
    block = np.bincount(item, weights=flag & 1, minlength=len(every)) > 0
    hit = ((places > 1) & block)[item]
    cuts = np.cumsum([len(v) for v in values])[:-1]
    return [np.packbits(h).tobytes() for h in np.split(hit, cuts)]


def _bits(answers: dict, phase: int, dealt: chunks.Dealt) -> np.ndarray:
    return dealt.gathered({b: np.unpackbits(np.frombuffer(answers[phase, b], np.uint8), count=len(v)).astype(bool)
                           for b, v in dealt.values.items()}, bool)


class _Candidates:
    """The windows of a chunk that hold a hit, and their identities."""

    def __init__(self, table: pa.Table, answers: dict, n: int, window: int, block: int):
        self.ids = _ids(table.column("key"))
        self.words = w = Words(table.column("text").to_pylist())
        at, probes = _probes(w, block, n)
        hits = np.zeros(len(w.doc) + 1, np.int64)
        if len(at):
            hits[at + 1] = _bits(answers, 1, probes)[probes.item]
        upto = np.cumsum(hits)
        starts = w.windows(window)
        # probes that lie whole in the window
        self.starts = starts[upto[starts + window - block + 1] > upto[starts]] if len(starts) else starts
        a = w.starts[self.starts].tolist()
        b = w.stops[self.starts + window - 1].tolist()
        digest = xxhash.xxh3_128_digest
        wide = np.frombuffer(b"".join([digest(w.text[i:j]) for i, j in zip(a, b)]), np.uint64).reshape(-1, 2)
        # the pair as one item; the second half goes along
        self.dealt = chunks.Dealt(wide[:, 0] ^ (wide[:, 1] << np.uint64(1)), n)
        self.second = np.zeros(self.dealt.n_items, np.uint64)
        self.second[self.dealt.item] = wide[:, 1]
        self.doc = w.doc[self.starts]
        self.least = np.full(self.dealt.n_items, _LAST)
        np.minimum.at(self.least, self.dealt.item, self.ids[self.doc])


def _earliest(asks: list[bytes]) -> list[bytes]:
    """One bit for each window: a smaller document has it elsewhere."""
    parts = [chunks.unframe(a) for a in asks]
    first = [unpack(p[0]) for p in parts]
    sizes = [len(f) for f in first]
    second = np.concatenate([unpack_any(p[1], n) for p, n in zip(parts, sizes)])
    least = np.concatenate([unpack_any(p[2], n) for p, n in zip(parts, sizes)]).view(np.int64)
    first = np.concatenate(first)
    order = np.lexsort((least, second, first))
    f, s, d = first[order], second[order], least[order]
    new = np.concatenate(([True], (f[1:] != f[:-1]) | (s[1:] != s[:-1])))
    lowest = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(first), bool)
    later[order] = lowest < d
    return [np.packbits(x).tobytes() for x in np.split(later, np.cumsum(sizes)[:-1])]


def _first_of_row(dealt_item: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a window is the first of its kind in its row (windows come in order)."""
    order = np.lexsort((np.arange(len(doc)), doc, dealt_item))
    i, d = dealt_item[order], doc[order]
    new = np.concatenate(([True], (i[1:] != i[:-1]) | (d[1:] != d[:-1])))[:len(order)]
    out = np.zeros(len(order), bool)
    out[order] = new
    return out


def repeats_removed(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                    block: int = BLOCK) -> DataFrame:
    """For each row: key, n_words, spans (removed word ranges, maximal) and kept
    (the words left, joined by one space).

    A word is removed if a window of ``window`` words that covers it also starts
    in a row with a smaller key, or earlier in the same row, judged on the input.
    Rows with equal keys do not count as smaller than each other; a null
    key is larger than all. Null and empty texts have no words. Keys are integers.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block at any place")
    docs, n = chunks.staged(df, key, text)
    kind = docs.schema["key"].dataType.simpleString()

    def probe(table, _):
        words = Words(table.column("text").to_pylist())
        at, dealt = _probes(words, block, n)
        flags = _flags(words, at, dealt, block)
        return {b: chunks.frame(pack(v), flags[dealt.of[b]].tobytes()) for b, v in dealt.values.items()}

    hits = chunks.asked(docs, probe, _meet, 1)

    def extend(table, answers):
        c = _Candidates(table, answers, n, window, block)
        return {b: chunks.frame(pack(v), pack_any(c.second[c.dealt.of[b]]),
                                pack_any(c.least[c.dealt.of[b]].view(np.uint64)))
                for b, v in c.dealt.values.items()}

    later = chunks.asked(docs, extend, _earliest, 2, before=hits)

    def cut(table, answers):
        c = _Candidates(table, answers, n, window, block)
        w = c.words
        covered = np.zeros(len(w.doc) + 1, np.int64)
        if len(c.starts):
            item = c.dealt.item
            gone = (_bits(answers, 2, c.dealt)[item] | (c.ids[c.doc] > c.least[item])
                    | ~_first_of_row(item, c.doc))
            np.add.at(covered, c.starts[gone], 1)
            np.add.at(covered, c.starts[gone] + window, -1)
        removed = np.cumsum(covered)[:-1] > 0
        kept, spans = [], []
        for i, j in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            r = removed[i:j]
            if not r.any():
                kept.append(w.text[w.starts[i]:w.stops[j - 1]] if j > i else b"")
                spans.append([])
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([0], r.view(np.int8), [0]))))
            spans.append([{"start": a, "stop": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
            left = np.flatnonzero(np.diff(np.concatenate(([0], (~r).view(np.int8), [0])))).tolist()
            kept.append(b" ".join(w.text[w.starts[i + a]:w.stops[i + b - 1]] for a, b in zip(left[::2], left[1::2])))
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        return pa.table({"key": table.column("key"), "n_words": pa.array(np.diff(w.first), pa.int64()),
                         "spans": pa.array(spans, pa.list_(span)), "kept": pa.array([k.decode() for k in kept])})

    return chunks.applied(docs, hits.union(later), cut,
                          f"key {kind}, n_words long, spans array<struct<start:int,stop:int>>, kept string"
                          ).withColumnRenamed("key", key)
