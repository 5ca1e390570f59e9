"""Hashes of any slices of a byte buffer, and packed sorted numbers (numpy)."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_LETTERS = np.random.default_rng(20231113).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []
#: Length for which the powers are kept.
_KEPT = 1 << 21


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(max(n, _KEPT), base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    if n <= _KEPT:
        _POWERS[:] = out
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX[0])
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(33))


class Slices:
    """64-bit hashes of slices of a buffer; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * powers[:len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        raw = (self.sums[stops] - self.sums[starts]) * self.inverse[starts]
        return mix(raw ^ (stops - starts).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all slices of ``n`` bytes, by start."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:-n]) * self.inverse[:len(self.sums) - n])


def slice_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Hashes of slices whose starts are sorted, over ``step`` bytes of the buffer at a time."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = int(np.searchsorted(starts, base + step))
        part = Slices(data[base:int(stops[at:to].max())])
        out[at:to] = part.hash(starts[at:to] - base, stops[at:to] - base)
        at = to
    return out


def pack(a: np.ndarray) -> bytes:
    """Sorted unsigned numbers as byte planes of their differences; the shuffle's
    own compression then removes the empty planes."""
    if not len(a):
        return b""
    a = a.astype(np.uint64)
    planes = np.diff(a).view(np.uint8).reshape(-1, 8).T
    used = planes.any(axis=1) if len(a) > 1 else np.zeros(8, bool)
    return a[:1].tobytes() + np.packbits(used).tobytes() + np.ascontiguousarray(planes[used]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    used = np.unpackbits(np.frombuffer(data, np.uint8, 1, 8)).astype(bool)
    width = int(used.sum())
    n = (len(data) - 9) // width if width else 0
    steps = np.zeros((n, 8), np.uint8)
    steps[:, used] = np.frombuffer(data, np.uint8, n * width, 9).reshape(width, n).T
    return np.cumsum(np.concatenate((np.frombuffer(data, np.uint64, 1), steps.view(np.uint64).ravel())),
                     dtype=np.uint64)


def pack_any(a: np.ndarray) -> bytes:
    """Unsigned numbers in any order, as byte planes of the numbers themselves."""
    planes = np.ascontiguousarray(a.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T
    used = planes.any(axis=1) if len(a) else np.zeros(8, bool)
    return np.packbits(used).tobytes() + np.ascontiguousarray(planes[used]).tobytes()


def unpack_any(data: bytes, n: int) -> np.ndarray:
    used = np.unpackbits(np.frombuffer(data, np.uint8, 1)).astype(bool)
    out = np.zeros((n, 8), np.uint8)
    out[:, used] = np.frombuffer(data, np.uint8, n * int(used.sum()), 1).reshape(-1, n).T
    return out.view(np.uint64).ravel()


class Words:
    """The words of many texts: runs of anything but ASCII white space.

    ``text``: the words of all texts, each followed by one space; ``starts`` and
    ``stops`` of the words in it; ``doc``: the text of each word."""

    def __init__(self, texts: list[bytes]):
        parts = [b" ".join(t.split()) for t in texts]
        self.text = b" ".join(parts) + b" "
        self.data = np.frombuffer(self.text, np.uint8)
        gaps = np.flatnonzero(self.data == 32)
        starts = np.concatenate(([0], gaps[:-1] + 1)) if len(gaps) else np.zeros(0, np.int64)
        some = gaps > starts  # an empty text leaves a gap without a word
        self.starts, self.stops = starts[some], gaps[some]
        heads = np.cumsum([0, *(len(p) + 1 for p in parts)])
        self.doc = np.searchsorted(heads, self.starts, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))

    def windows(self, n: int) -> np.ndarray:
        """First words of all windows of n words that lie in one text."""
        if len(self.doc) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[n - 1:] == self.doc[:len(self.doc) - n + 1])
