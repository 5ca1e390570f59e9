"""Suffix-array deduplication over the common-prefix interval tree.

A string of ``LENGTH`` bytes is anchored at the smallest hash among its
``GRAM``-byte substrings. Equal strings have equal anchors at equal places, so
they meet under the anchor's hash, and consecutive strings mostly share an
anchor. First the anchors that occur in two rows are found (five bytes less
what packing saves for each anchor, one bit back, see ``chunks``). Then, for
those alone, the stretch of text whose strings they anchor goes to the
anchor's bucket, each distinct stretch of a chunk once, with the smallest row
key that holds it.

A bucket sorts the suffixes of its distinct stretches that start an anchored
string: its part of the enhanced suffix array, with the common prefix lengths
of neighbours. One scan with a stack yields the tree of intervals with common
prefixes of ``LENGTH`` and more. An outermost interval is one repeated string
with all its occurrences: its smallest row decides for all of them. An interval
whose members are preceded by different bytes cannot be extended to the left:
a maximal repeat group. A stretch reaches from the first to the end of the
last string of its anchor, so a group is maximal within up to 2 * ``LENGTH`` - ``GRAM``
bytes; a longer repeat is a chain of overlapping groups, whose spans are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import chunks
from fleetscope.llm.common import written
from fleetscope.llm.rolling import Slices, pack, pack_any, slice_hashes, unpack, unpack_any

LENGTH = 50
GRAM = 24
#: Buckets of stretches for each bucket of anchors.
FINER = 8
#: An anchor of more places is hot: its strings are dealt one by one. Chunks count exactly beyond ``MANY``.
HOT, MANY = 4096, 16
#: Bytes hashed at a time.
SEGMENT = 1 << 20
_LAST = np.iinfo(np.int64).max
#: Before the start of a stretch: differs from every byte, and from itself.
_EDGE = 256


class _Anchored:
    """The texts of a chunk in one buffer, and their anchors in order: place,
    first and last start of the strings they anchor, row and hash."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        texts = table.column("text").to_pylist()
        self.ids = np.array([_LAST if x is None else x for x in table.column("key").to_pylist()], np.int64)
        self.heads = np.cumsum([0, *map(len, texts)])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.repeat(self.heads[1:], np.diff(self.heads))
        span = length - gram + 1
        found = []
        for at in range(0, max(0, len(self.data) - length + 1), SEGMENT):
            part = self.data[at:at + SEGMENT + length - 1]
            hashes = Slices(part).grams(gram)
            # hash and place in one number; the smallest of each run of `span` by doubling
            least = hashes & ~np.uint64(0xFFFFFF) | np.arange(len(hashes), dtype=np.uint64)
            width = 1
            while width < span:
                step = min(width, span - width)
                least = np.minimum(least[:len(least) - step], least[step:])
                width += step
            starts = np.arange(at, at + len(least))
            inside = starts + length <= ends[starts]
            place = (least & np.uint64(0xFFFFFF)).astype(np.int64)[inside]
            starts = starts[inside]
            if not len(starts):
                continue
            new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(starts) != 1))))
            last = np.concatenate((new[1:], [len(starts)])) - 1
            found.append((starts[new], starts[last], hashes[place[new]]))
        self.first, self.last, self.hash = (np.concatenate(x) for x in zip(*found)) if found else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.row = np.searchsorted(self.heads, self.first, side="right") - 1


def _ask_anchors(a: _Anchored, n: int) -> tuple[chunks.Dealt, np.ndarray]:
    """Anchors dealt to buckets; whether an item stands in two rows of the chunk."""
    dealt = chunks.Dealt(a.hash, n, bits=40)
    low, high = np.full(dealt.n_items, len(a.ids)), np.full(dealt.n_items, -1)
    np.minimum.at(low, dealt.item, a.row)
    np.maximum.at(high, dealt.item, a.row)
    return dealt, low < high


def _asked(dealt: chunks.Dealt, two: np.ndarray) -> dict[int, bytes]:
    """What a chunk says of its anchors: in two rows or not, and places of the frequent ones."""
    places = np.bincount(dealt.item, minlength=dealt.n_items)
    out = {}
    for b, v in dealt.values.items():
        of = dealt.of[b]
        many = np.flatnonzero(places[of] > MANY)
        out[b] = chunks.frame(pack(v), np.packbits(two[of]).tobytes(), pack(many), pack_any(places[of][many]))
    return out


def _bits(answers: dict, dealt: chunks.Dealt) -> tuple[np.ndarray, np.ndarray]:
    """Whether the items are repeated, and whether they are hot."""
    repeated, hot = {}, {}
    for b, v in dealt.values.items():
        raw = np.unpackbits(np.frombuffer(answers[1, b], np.uint8)).astype(bool)
        n = -(-len(v) // 8) * 8
        repeated[b] = raw[:len(v)]
        hot[b] = raw[n:n + len(v)] if len(raw) > n else np.zeros(len(v), bool)
    return dealt.gathered(repeated, bool), dealt.gathered(hot, bool)


def _repeated(asks: list[bytes]) -> list[bytes]:
    """One bit for each anchor: it stands in two rows; then, if any is hot, one for that."""
    parts = [chunks.unframe(a) for a in asks]
    values = [unpack(p[0]) for p in parts]
    flags = [np.unpackbits(np.frombuffer(p[1], np.uint8), count=len(v)) for p, v in zip(parts, values)]
    every, item = np.unique(np.concatenate(values), return_inverse=True)
    least = [1 + f.astype(np.int64) for f in flags]
    rows = np.bincount(item, weights=np.concatenate(least), minlength=len(every))
    for n, p in zip(least, parts):
        if len(many := unpack(p[2]).astype(np.int64)):
            n[many] = unpack_any(p[3], len(many))
    hot = np.bincount(item, weights=np.concatenate(least), minlength=len(every)) > HOT
    cuts = np.cumsum([len(v) for v in values])[:-1]
    return [np.packbits(x).tobytes() + (np.packbits(h).tobytes() if h.any() else b"")
            for x, h in zip(np.split((rows > 1)[item], cuts), np.split(hot[item], cuts))]


class _Stretches:
    """The distinct stretches of a chunk under repeated anchors, by bucket.

    ``split``: a stretch under a hot anchor is cut into its strings of ``length`` bytes, each dealt by
    its own hash, so that a hot anchor with many surroundings fills no single bucket. Equal strings
    have equal anchors, so either all of them are cut or none."""

    def __init__(self, a: _Anchored, answers: dict, n: int, length: int, split: bool = False):
        self.a = a
        dealt, _ = _ask_anchors(a, n)
        bits, hot = _bits(answers, dealt)
        anchor = np.flatnonzero(bits[dealt.item]) if len(a.hash) else np.zeros(0, np.int64)
        first, last, cut = a.first[anchor], a.last[anchor], np.zeros(len(anchor), bool)
        if split and len(anchor) and (cut := hot[dealt.item[anchor]]).any():
            pieces = np.where(cut, last - first + 1, 1)
            anchor, cut = np.repeat(anchor, pieces), np.repeat(cut, pieces)
            first = np.repeat(first, pieces) + np.arange(len(anchor)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            last = np.where(cut, first, a.last[anchor])
        self.anchor, self.first = anchor, first
        text = a.data.tobytes()
        seen: dict[bytes, int] = {}
        self.entry = np.array([seen.setdefault(text[i:j], len(seen)) for i, j in zip(
            first.tolist(), (last + length).tolist())], np.int64)
        self.texts = list(seen)
        self.starts = np.array([len(t) - length + 1 for t in self.texts], np.int64)
        self.least = np.full(len(seen), _LAST)
        np.minimum.at(self.least, self.entry, a.ids[a.row[self.anchor]])
        self.count = np.bincount(self.entry, minlength=len(seen))
        hashes = np.zeros(len(seen), np.uint64)
        own = a.hash[self.anchor]
        own[cut] = slice_hashes(a.data, first[cut], first[cut] + length)
        # a whole stretch may equal a cut string only if the anchor is the same, so both are cut
        hashes[self.entry] = own
        bucket = ((hashes & np.uint64(0xFFFFFF)) % np.uint64(n * FINER)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        self.of = {int(bucket[p[0]]): p for p in np.split(order, cuts)} if len(order) else {}

    def asks(self) -> dict[int, bytes]:
        return {b: chunks.frame(self.starts[p].astype(np.uint16).tobytes(), b"".join([self.texts[i] for i in p.tolist()]),
                                pack_any(self.least[p].view(np.uint64)), pack_any(self.count[p])) for b, p in self.of.items()}


class SuffixBucket:
    """Enhanced suffix array of the distinct stretches of one bucket."""

    def __init__(self, asks: list[bytes], length: int):
        parts = [chunks.unframe(a) for a in asks]
        starts = [np.frombuffer(p[0], np.uint16).astype(np.int64) for p in parts]
        self.sizes = [len(s) for s in starts]
        self.length = length
        self.starts = np.concatenate(starts)                     # of each entry
        self.least = np.concatenate([unpack_any(p[2], n) for p, n in zip(parts, self.sizes)]).view(np.int64)
        count = np.concatenate([unpack_any(p[3], n) for p, n in zip(parts, self.sizes)]).astype(np.int64)
        seen: dict[bytes, int] = {}
        distinct = []
        for p, s in zip(parts, starts):
            ends = np.cumsum(s + length - 1)
            distinct += [seen.setdefault(p[1][i:j], len(seen)) for i, j in zip(
                (ends - s - length + 1).tolist(), ends.tolist())]
        self.text_of = np.array(distinct, np.int64)              # distinct stretch of each entry
        self.texts = list(seen)
        n = len(self.texts)
        self.text_least = np.full(n, _LAST)
        np.minimum.at(self.text_least, self.text_of, self.least)
        self.text_count = np.bincount(self.text_of, weights=count, minlength=n).astype(np.int64)

        # suffixes that start an anchored string, padded by zeros (a zero byte counts as 255)
        text_starts = np.array([len(t) - length + 1 for t in self.texts], np.int64)
        pad = int(text_starts.max()) - 1
        width = length + pad
        raw = np.frombuffer((b"\0" * pad).join([t.replace(b"\0", b"\xff") for t in self.texts]) + b"\0" * width, np.uint8)
        heads = np.cumsum(text_starts + length - 1 + pad) - (text_starts + length - 1 + pad)
        self.base = np.cumsum(text_starts) - text_starts         # first suffix of each stretch
        stretch = np.repeat(np.arange(n), text_starts)
        offset = np.arange(len(stretch)) - self.base[stretch]
        at = heads[stretch] + offset
        rows = np.lib.stride_tricks.sliding_window_view(raw, width)[at]
        self.order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
        rows = rows[self.order]
        self.stretch, self.offset = stretch[self.order], offset[self.order]
        valid = text_starts[self.stretch] - self.offset + length - 1
        same = rows[1:] == rows[:-1]
        equal = np.where(same.all(axis=1), width, same.argmin(axis=1)) if len(rows) > 1 else np.zeros(0, np.int64)
        self.lcp = np.minimum(equal, np.minimum(valid[1:], valid[:-1]))
        self.doc = self.text_least[self.stretch]
        self.left = np.where(self.offset == 0, _EDGE, raw[at[self.order] - 1].astype(np.int64))

    def intervals(self) -> list[tuple[int, int, int, bool]]:
        """(common prefix, first, last suffix, outermost) of the intervals of
        two and more suffixes with common prefixes of ``length`` and more."""
        out, stack = [], []
        for i in np.flatnonzero(self.lcp >= self.length).tolist():
            lcp = int(self.lcp[i])
            start = i
            if stack and stack[-1][2] != i:  # the run has ended before: close all
                self._close(stack, out, 0)
            while stack and stack[-1][0] > lcp:
                top, start, end = stack.pop()
                out.append((top, start, end, False))
                if stack:
                    stack[-1][2] = end
            if not stack or stack[-1][0] < lcp:
                stack.append([lcp, start, i + 1])
            else:
                stack[-1][2] = i + 1
        self._close(stack, out, 0)
        return out

    @staticmethod
    def _close(stack: list, out: list, to: int) -> None:
        while len(stack) > to:
            lcp, start, end = stack.pop()
            out.append((lcp, start, end, not stack))
            if stack:
                stack[-1][2] = end

    def smallest(self) -> np.ndarray:
        """For each suffix, by stretch and offset, the smallest row that holds its string."""
        least = self.doc.copy()
        for _, i, j, outermost in self.intervals():
            if outermost:
                least[i:j + 1] = least[i:j + 1].min()
        out = np.empty_like(least)
        out[self.order] = least
        return out

    def later(self) -> list[bytes]:
        """For each entry a bit for each start: a smaller row holds the string."""
        least = self.smallest()
        first = np.cumsum(self.starts) - self.starts
        entry = np.repeat(np.arange(len(self.starts)), self.starts)
        offset = np.arange(len(entry)) - first[entry]
        bit = least[self.base[self.text_of[entry]] + offset] < self.least[entry]
        upto = np.concatenate(([0], np.cumsum(self.starts)))[np.cumsum([0, *self.sizes])]
        return [np.packbits(bit[i:j]).tobytes() for i, j in zip(upto[:-1], upto[1:])]

    def groups(self) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
        """Maximal repeat groups: (length, occurrences, smallest row, members), the
        members as (distinct stretch, offset). A stretch that occurs more than
        once is a group by itself unless a wider one has its string."""
        out = []
        for lcp, i, j, _ in self.intervals():
            left = self.left[i:j + 1]
            if (left == _EDGE).any() or (left != left[0]).any():
                members = list(zip(self.stretch[i:j + 1].tolist(), self.offset[i:j + 1].tolist()))
                out.append((lcp, int(self.text_count[self.stretch[i:j + 1]].sum()), int(self.doc[i:j + 1].min()), members))
        for k in np.flatnonzero(self.text_count > 1).tolist():
            out.append((len(self.texts[k]), int(self.text_count[k]), int(self.text_least[k]), [(k, 0)]))
        return out


def _staged_anchors(df: DataFrame, key: str, text: str, length: int, gram: int):
    docs, n = chunks.staged(df, key, text)

    def ask(table, _):
        return _asked(*_ask_anchors(_Anchored(table, length, gram), n))
    return docs, chunks.asked(docs, ask, _repeated, 1), n


def repeats_removed(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    gram: int = GRAM) -> DataFrame:
    """For each row: key, n_bytes, spans (removed byte ranges, maximal) and kept
    (the bytes left, binary).

    A byte of the UTF-8 text is removed if a string of ``length`` bytes that
    covers it also starts in a row with a smaller key; judged on the input, and
    never across rows. Equal keys are not smaller than each other; a null key is
    larger than all. Null and empty texts have no bytes. Keys are integers.
    """
    docs, anchors, n = _staged_anchors(df, key, text, length, gram)
    kind = docs.schema["key"].dataType.simpleString()

    def stretches(table, answers):
        return _Stretches(_Anchored(table, length, gram), answers, n, length, split=True).asks()

    later = chunks.asked(docs, stretches, lambda asks: SuffixBucket(asks, length).later(), 2, before=anchors)

    def cut(table, answers):
        a = _Anchored(table, length, gram)
        s = _Stretches(a, answers, n, length, split=True)
        # by entry and start: a smaller row elsewhere
        base = np.cumsum(s.starts) - s.starts
        bits = np.zeros(int(s.starts.sum()), bool)
        for b, places in s.of.items():
            sizes = s.starts[places]
            own = np.unpackbits(np.frombuffer(answers[2, b], np.uint8), count=int(sizes.sum())).astype(bool)
            bits[np.repeat(base[places] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))] = own
        # by place: or this row is not the smallest that holds the stretch
        sizes = s.starts[s.entry]
        offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        gone = bits[np.repeat(base[s.entry], sizes) + offset]
        gone |= np.repeat(a.ids[a.row[s.anchor]] > s.least[s.entry], sizes)
        starts = (np.repeat(s.first, sizes) + offset)[gone]
        removed = np.zeros(len(a.data) + 1, np.int32)
        removed[starts + 1] = 1
        removed = np.cumsum(removed, dtype=np.int32)
        covered = removed[1:] - removed[np.maximum(np.arange(len(a.data)) - length + 1, 0)] > 0
        kept, spans = [], []
        for i, j in zip(a.heads[:-1].tolist(), a.heads[1:].tolist()):
            c = covered[i:j]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], c.view(np.int8), [0])))).tolist()
            spans.append([{"start": x, "stop": y} for x, y in zip(edge[::2], edge[1::2])])
            kept.append(a.data[i:j][~c].tobytes() if edge else a.data[i:j].tobytes())
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        return pa.table({"key": table.column("key"), "n_bytes": pa.array(np.diff(a.heads), pa.int64()),
                         "spans": pa.array(spans, pa.list_(span)), "kept": pa.array(kept, pa.binary())})

    return chunks.applied(docs, anchors.union(later), cut,
                          f"key {kind}, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary"
                          ).withColumnRenamed("key", key)


def maximal_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    gram: int = GRAM) -> DataFrame:
    """The maximal repeat groups with all their occurrences: group (the repeated
    bytes), n_occurrences of the group, key, start (byte) and the group's
    first_key. A group is a string of ``length`` and more bytes (see above for the most)
    under a repeated anchor that occurs with different bytes before it, or one
    stretch of text that occurs more than once. Rows as in :func:`repeats_removed`."""
    docs, anchors, n = _staged_anchors(df, key, text, length, gram)
    kind = docs.schema["key"].dataType.simpleString()

    def places(table, answers):
        s = _Stretches(_Anchored(table, length, gram), answers, n, length)
        a = s.a
        entry, at = s.entry, s.anchor
        return pa.table({"stretch": pa.array([s.texts[i] for i in entry.tolist()], pa.binary()),
                         "key": table.column("key").take(pa.array(a.row[at])),
                         "at": pa.array(a.first[at] - a.heads[a.row[at]])})

    def stretches(table, answers):
        return _Stretches(_Anchored(table, length, gram), answers, n, length).asks()

    def tree(table):
        bucket = SuffixBucket(table.column("ask").to_pylist(), length)
        rows = [(bucket.texts[k][o:o + size], count, bucket.texts[k], o)
                for size, count, _, members in bucket.groups() for k, o in members]
        return pa.table({"group": pa.array([r[0] for r in rows], pa.binary()),
                         "n_occurrences": pa.array([r[1] for r in rows], pa.int64()),
                         "stretch": pa.array([r[2] for r in rows], pa.binary()),
                         "offset": pa.array([r[3] for r in rows], pa.int64())})

    asks = chunks._questions(stretches, docs, anchors)
    groups = written(asks.groupBy("bucket").applyInArrow(
        lambda t: tree(t), "group binary, n_occurrences long, stretch binary, offset long"), "groups")
    found = chunks.applied(docs, anchors, places, f"stretch binary, key {kind}, at long")
    return groups.distinct().join(found, "stretch").select(
        "group", "n_occurrences", F.col("key").alias(key), (F.col("at") + F.col("offset")).alias("start"))
