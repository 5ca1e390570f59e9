"""Byte-level BPE encoding and decoding by backtracking over token matches.

The bytes of a piece are mapped to Latin-1, one character each, so that an
Aho-Corasick automaton of the vocabulary finds all tokens in it. From the
left, the longest token is tried first, then its shorter prefixes; a token is
taken if it is compatible with the one before it, and a position from which
nothing fits is marked and never tried again. Two adjacent tokens are
compatible if the merges, run over their joined bytes, give the same two
tokens back; this is memoised for each pair. A sequence whose adjacent pairs
are all compatible is exactly what the merges produce, so the result equals
the merge loop's in linear time, whatever the length of the piece.

Each text is cut into pieces by the pre-tokenizer's pattern; pieces repeat, so
their encodings are kept in a bounded memo for each Python worker. Rows are
independent: no shuffle, nothing gathered, a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import worker_state

#: Pieces and pairs that a worker keeps; the memo is emptied when it is full.
MEMO_PIECES = 1_000_000
MEMO_PAIRS = 1_000_000
#: Rows in a result batch.
BATCH_ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairCoder:
    """Encodes and decodes with the merges that ``ranks`` imply."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.bytes_of_text = {str(v): k for k, v in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.memo: dict[str, str] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.automaton = ahocorasick.Automaton()
        # a token that the merges never build cannot be part of their result
        usable = [t for t in ranks if self.merged(t) == [t]]
        for t in usable:
            self.automaton.add_word(t.decode("latin-1"), t)
        self.automaton.make_automaton()
        self.usable = set(usable)

    def merged(self, data: bytes) -> list[bytes]:
        """The merge loop, lowest rank first, leftmost on ties; for short data only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i)
                           for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: bytes, b: bytes) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def split(self, data: bytes) -> list[bytes]:
        """The tokens of one piece."""
        if data in self.ranks:
            return [data]
        longest: list[bytes] = [b""] * len(data)
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - len(token) + 1] = token  # ends come in order: the longest is last
        out: list[bytes] = []
        dead = bytearray(len(data) + 1)
        at, token = 0, longest[0]
        while at < len(data):
            while token and (dead[at + len(token)] or out and not self.compatible(out[-1], token)):
                token = self.shorter(token)
            if token:
                out.append(token)
                at += len(token)
                token = longest[at] if at < len(data) else b""
            else:  # nothing fits here: give back the last token, try its shorter prefixes
                dead[at] = 1
                last = out.pop()
                at -= len(last)
                token = self.shorter(last)
        return out

    def shorter(self, token: bytes) -> bytes:
        """The longest usable proper prefix."""
        for n in range(len(token) - 1, 0, -1):
            if token[:n] in self.usable:
                return token[:n]
        return b""

    def _listed(self, piece: str) -> str:
        """Decimal ids of one piece, joined by a space."""
        known = self.memo.get(piece)
        if known is None:
            if len(self.memo) >= MEMO_PIECES:
                self.memo.clear()
            ids = [self.ranks[t] for t in self.split(piece.encode())]
            known = " ".join(map(str, ids))
            if len(piece) <= 64:
                self.memo[piece] = known
        return known

    def encoded_text(self, text: str) -> str:
        """All ids of a text as decimals joined by one space."""
        memo, listed = self.memo, self._listed
        return " ".join([memo.get(p) or listed(p) for p in self.pieces(text)])

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encoded_text(text).split()]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode_text(self, ids: list[str]) -> bytes:
        """Like :meth:`decode`, from decimal ids."""
        return b"".join(map(self.bytes_of_text.__getitem__, ids))


def coder(path: str, pattern: str) -> BytePairCoder:
    """The coder that a Python worker keeps."""
    return worker_state(("bpe", path, pattern), lambda: BytePairCoder(read_ranks(path), pattern))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(i, BATCH_ROWS)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids array<int>) for each row. A null text is the empty text, with
    no ids; null keys and repeated rows are kept; other columns are ignored."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        c = coder(path, pattern)
        for b in _parts(batches):
            ids = pa.array([c.encode(x or "") for x in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [key, "ids"])
    return df.select(key, F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
           ids: str = "ids") -> DataFrame:
    """(key, bytes binary) for each row of ids; null ids are no ids. An id that
    the vocabulary lacks raises."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        c = coder(path, pattern)
        for b in _parts(batches):
            data = pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), data], [key, "bytes"])
    return df.select(key, F.col(ids).alias("ids")).mapInArrow(run, f"`{key}` {kind}, bytes binary")


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
               text: str = "text", with_ids: bool = False) -> DataFrame:
    """Digest of encoding and decoding in one pass, so that ids and bytes need
    not leave the worker: key, n_tokens, ids_sha256 (decimal ids joined by one
    space), decoded_sha256 (bytes decoded from those ids), and the ids
    themselves if asked for. Rows as in :func:`encode`."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        c = coder(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in _parts(batches):
            n, a, d, every = [], [], [], []
            for x in b.column(1).to_pylist():
                listed = c.encoded_text(x or "")
                ids = listed.split(" ") if listed else []
                n.append(len(ids))
                every.append([int(i) for i in ids] if with_ids else None)
                a.append(sha(listed.encode()))
                d.append(sha(c.decode_text(ids)))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
            if with_ids:
                columns.append(pa.array(every, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    return df.select(key, F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
             + ", ids array<int>" * with_ids)
