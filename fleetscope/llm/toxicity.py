"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

The examples are a bounded sample of the labelled rows (``EXAMPLES`` distinct
texts of each class, those with the smallest hash of the text; a text labelled both ways is an
example of both). Terms are all words of the examples, the beginnings of words
(``STEMS`` characters) and, of scripts that put no spaces between words, the pairs of
neighbouring letters beyond ASCII; no term is left out, so their number is bounded by the
examples' texts alone. Their document frequencies, like the class sizes, are counted over
all rows. The example vectors form a block-max inverted index: examples that share their
most telling common term lie in the same blocks. Rare terms have posting lists; a common
term (in more than one of ``COMMON`` examples) has its weights by block, and the largest of
each block. Documents are searched a batch at a time: each adds up its rare terms exactly and
bounds its cosine to every block by the best of these sums and the maxima of its common
terms; the blocks of the highest bounds are opened, one matrix product for all documents
that open a block, and then those whose bound reaches the k-th best cosine found: the k
nearest examples are exact.

Votes are weighted by 1 / (1 - cosine) and by how many labelled rows an example
of its class stands for, with ``PRIOR`` votes for the share of the class in all
rows. An isotonic fit over the examples, each scored without itself, turns the
share of votes into a calibrated score. The index has a proven size bound
(examples x terms) and is broadcast. Documents are scored where they lie.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import worker_state
from fleetscope.llm.decontaminate import words

#: Distinct labelled texts of each class that serve as examples.
EXAMPLES = 1500
#: Longer words count by their beginnings and letter pairs alone (bytes).
TERM_BYTES = 64
STEMS = range(3, 9)
#: Words whose terms a worker remembers: those it meets first, so mostly the frequent ones. They lie
#: in a table of so many slots (12 bytes each).
MEMO_WORDS, MEMO_SLOTS, PAIRED_WORDS = 600_000, 1 << 20, 50_000
NEIGHBOURS = 15
BLOCK = 64
#: A term in more than one of so many examples is common.
COMMON = 16
#: Blocks that a document opens before it knows its k-th best cosine.
FIRST = 8
#: Texts scored together, and the bytes of text after which a batch is closed.
BATCH_TEXTS, BATCH_BYTES = 128, 2 << 20
#: Cosines are rounded to so many places: a matrix product's last bits depend on the batch.
PLACES = 12
PRIOR = 0.05
#: Rows of a batch that are taken at a time, and rows in the Arrow batches that Spark sends: a
#: worker holds a model beside them.
BATCH_ROWS, ARROW_ROWS = 1024, 2048
#: Distance added to all, so that equal vectors have a finite vote.
SHARP = 0.05
REJECT = 0.7


_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]{2,}")


def features(word: bytes) -> list[bytes]:
    """The word (up to ``TERM_BYTES``), its beginnings, marked by a hyphen, and its pairs of letters
    beyond ASCII, marked by a tilde; no word has these marks."""
    letters = word.decode("utf-8", "replace")
    out = [word] if len(word) <= TERM_BYTES else []
    out += (letters[:n].encode() + b"-" for n in STEMS if n < len(letters))
    if len(letters) < len(word):
        out += dict.fromkeys(run[i:i + 2].encode() + b"~" for run in _BEYOND_ASCII.findall(letters) for i in range(len(run) - 1))
    return out


def _batches(texts: list[bytes]):
    """Ranges of texts to be scored together; a text beyond ``BATCH_BYTES`` closes its batch."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if i + 1 - first == BATCH_TEXTS or size >= BATCH_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


class Vocabulary:
    """Numbers of the terms, and what a worker remembers of words met before."""

    def __init__(self, terms: list[bytes]):
        """``terms``: ascending, each once."""
        self.joined = b"\n".join(terms)  # no word has a line end; the numbers are made where they are used
        self.size = len(terms)
        #: Of each term the next shorter beginning, -1 for none; the last place makes -1 its own.
        self.shorter = np.full(self.size + 1, -1, np.int32)
        above: list[tuple[bytes, int]] = []  # the beginnings that the last term has: a hyphen sorts before all letters
        for i, t in enumerate(terms):
            if t.endswith(b"~"):
                continue
            own = t[:-1] if t.endswith(b"-") else t
            while above and not own.startswith(above[-1][0]):
                above.pop()
            if above:
                self.shorter[i] = above[-1][1]
            if own is not t:
                above.append((own, i))
        self.number: dict[bytes, int] | None = None

    def __getstate__(self):
        # the dicts are made by each worker
        return {"joined": self.joined, "size": self.size, "shorter": self.shorter, "number": None}

    @property
    def terms(self) -> list[bytes]:
        return self.joined.split(b"\n") if self.size else []

    def _open(self) -> None:
        # counting and scoring send equal vocabularies: a worker holds one of them
        self.joined, self.shorter, self.number, self.memo = worker_state(("toxicity", self.joined), lambda: (
            self.joined, self.shorter, {t: i for i, t in enumerate(self.terms)}, Memo()))

    def _longest(self, word: bytes) -> int:
        """The number of the longest known term that is the word or its beginning, -1 for none, ``PAIRS`` for
        a word with pairs of letters. What is known has all its shorter beginnings known."""
        number = self.number
        ascii = word.isascii()
        letters = word if ascii else word.decode("utf-8", "replace")
        if not ascii and _BEYOND_ASCII.search(letters):
            return PAIRS
        found = number.get(word) if len(word) <= TERM_BYTES else None
        if found is not None:
            return found
        low, high, found = STEMS.start - 1, min(STEMS.stop, len(letters)) - 1, -1
        while low < high:
            n = (low + high + 1) // 2
            t = number.get(letters[:n] + b"-" if ascii else letters[:n].encode() + b"-")
            if t is None:
                high = n - 1
            else:
                low, found = n, t
        return found

    def _words_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each word of the texts the longest known term (-1: none); where each text begins, with the
        end; and of the words with pairs of letters their terms, and for each the text."""
        if self.number is None:
            self._open()
        found = [words(t) for t in texts]
        cuts = np.cumsum([0, *map(len, found)])
        every = list(chain.from_iterable(found))
        del found
        hashes = np.fromiter(map(hash, every), np.int64, len(every))
        longest = self.memo.find(hashes)
        new = np.flatnonzero(longest == NOT_MET)
        if len(new):
            hashes, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            own = np.fromiter((self._longest(every[i]) for i in new[first].tolist()), np.int32, len(first))
            longest[new] = own[back]
            self.memo.add(hashes, own)
        paired = np.flatnonzero(longest == PAIRS)
        longest[paired] = -1
        packed = [self._packed(every[i]) for i in paired.tolist()]
        text = np.repeat(np.searchsorted(cuts, paired, side="right") - 1, [len(x) >> 2 for x in packed])
        return longest, cuts, np.frombuffer(b"".join(packed), np.int32), text

    def _packed(self, word: bytes) -> bytes:
        """The numbers of all known terms of a word with pairs of letters."""
        known = self.memo.paired
        terms = known.get(word)
        if terms is None:
            terms = array("i", [self.number[f] for f in features(word) if f in self.number]).tobytes()
            if len(word) <= TERM_BYTES and len(known) < PAIRED_WORDS:
                known[word] = terms
        return terms

    def held(self, texts: list[bytes]) -> np.ndarray:
        """The numbers of every text's terms, each once a text."""
        longest, cuts, others, text = self._words_of(texts)
        at, out = np.searchsorted(text, np.arange(len(texts) + 1)).tolist(), [np.zeros(0, np.int32)]
        for k, (i, j) in enumerate(pairwise(cuts.tolist())):
            level = np.sort(longest[i:j])
            levels = [level := level[_heads(level)]]
            for _ in STEMS:
                levels.append(level := self.shorter[level])
            term = np.sort(np.concatenate([*levels, others[at[k]:at[k + 1]]]))
            term = term[np.searchsorted(term, 0):]
            out.append(term[_heads(term)])
        return np.concatenate(out)

    def counts(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the numbers of its terms, ascending, and how often it has each."""
        longest, cuts, others, text = self._words_of(texts)
        at, out = np.searchsorted(text, np.arange(len(texts) + 1)).tolist(), []
        for k, (i, j) in enumerate(pairwise(cuts.tolist())):
            level = np.sort(longest[i:j])
            heads = _heads(level)
            n, level = np.diff(heads, append=len(level)), level[heads]
            levels = [level]
            for _ in STEMS:
                levels.append(level := self.shorter[level])
            # term and count in one number: one sort brings equal terms together
            pairs = (np.stack(levels).astype(np.int64) << 32 | n).ravel()
            pairs = pairs[pairs >= 0]
            if at[k + 1] > at[k]:
                pairs = np.concatenate([pairs, others[at[k]:at[k + 1]].astype(np.int64) << 32 | 1])
            pairs.sort()
            term = (pairs >> 32).astype(np.int32)
            heads = _heads(term)
            out.append((term[heads], np.add.reduceat(pairs & 0xFFFFFFFF, heads) if len(heads) else pairs))
        return out


def _heads(ascending: np.ndarray) -> np.ndarray:
    """The first place of each value."""
    return np.flatnonzero(np.concatenate((ascending[:1] == ascending[:1], ascending[1:] != ascending[:-1])))


#: In a memo: a word not met before, and one that has pairs of letters beyond ASCII.
NOT_MET, PAIRS = -3, -2


class Memo:
    """The longest terms of words, which are told apart by 64 bits of hash: a table of two arrays
    instead of a dict, so that a batch's words are looked up together. Words with pairs of letters
    have their packed terms in a dict."""

    def __init__(self):
        self.paired: dict[bytes, bytes] = {}
        self.hashes = np.zeros(MEMO_SLOTS, np.int64)
        self.longest = np.full(MEMO_SLOTS, NOT_MET, np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & (MEMO_SLOTS - 1)
        out = self.longest[slot]
        left = np.flatnonzero((self.hashes[slot] != hashes) & (out != NOT_MET))
        slot, hashes = slot[left], hashes[left]
        while len(left):
            slot = slot + 1 & MEMO_SLOTS - 1
            out[left] = own = self.longest[slot]
            more = np.flatnonzero((self.hashes[slot] != hashes) & (own != NOT_MET))
            left, slot, hashes = left[more], slot[more], hashes[more]
        return out

    def add(self, hashes: np.ndarray, longest: np.ndarray) -> None:
        """Distinct hashes that are not there yet; as many as there is room for."""
        hashes, longest = hashes[:MEMO_WORDS - self.size], longest[:MEMO_WORDS - self.size]
        self.size += len(hashes)
        slot = hashes & (MEMO_SLOTS - 1)
        while len(hashes):
            free = np.flatnonzero(self.longest[slot] == NOT_MET)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.hashes[slot[put]], self.longest[slot[put]] = hashes[put], longest[put]
            left = np.delete(np.arange(len(hashes)), put)
            hashes, longest, slot = hashes[left], longest[left], slot[left] + 1 & MEMO_SLOTS - 1


def _arrays(vector) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a vector: a dict, or these arrays already."""
    if isinstance(vector, dict):
        return np.fromiter(vector.keys(), np.int64, len(vector)), np.fromiter(vector.values(), float, len(vector))
    return vector


class BlockMaxIndex:
    """Exact nearest examples of unit vectors."""

    def __init__(self, vectors: list, n_terms: int):
        pairs = [_arrays(v) for v in vectors]
        held = np.bincount(np.concatenate([t for t, _ in pairs]), minlength=n_terms) if pairs else np.zeros(n_terms)
        telling = [int(t[np.lexsort((t, -w * held[t]))[0]]) if len(t) else -1 for t, w in pairs]
        self.order = np.array(sorted((i for i, t in enumerate(telling) if t >= 0), key=lambda i: (telling[i], i)), np.int64)
        n = len(self.order)
        self.heads = np.arange(0, n, BLOCK)
        if not n:
            return
        place = np.repeat(np.arange(n, dtype=np.int16 if n < 1 << 15 else np.int32), [len(pairs[i][0]) for i in self.order])
        term = np.concatenate([pairs[i][0] for i in self.order])
        weight = np.concatenate([pairs[i][1] for i in self.order])
        del pairs
        #: Number of a common term, -1 for a rare one.
        self.common = np.full(n_terms, -1, np.int32)
        many = np.flatnonzero(held * COMMON > len(vectors))
        self.common[many] = np.arange(len(many))
        self.n_common = len(many)
        number = self.common[term]
        rare = np.flatnonzero(number < 0)
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.cuts = np.searchsorted(term[rare], np.arange(n_terms + 1, dtype=term.dtype)).astype(np.int32 if len(rare) < 1 << 31 else np.int64)
        self.places, self.weights = place[rare], weight[rare]
        some = np.flatnonzero(number >= 0)
        #: The weights of the common terms, as they are sent: (number, place, weight).
        self.entries = number[some], place[some], weight[some]
        self.blocks: list[np.ndarray] | None = None

    def __getstate__(self):
        return {**self.__dict__, "blocks": None, "most": None}

    def __setstate__(self, state):
        self.__dict__ = {**state, "sent": True}

    def _open(self) -> None:
        number, place, weight = self.entries
        if self.__dict__.get("sent"):
            self.entries = None     # a worker sends it no further
        self.blocks = []
        for head in self.heads.tolist():
            i, j = np.searchsorted(place, (head, head + BLOCK))
            block = np.zeros((self.n_common, min(BLOCK, len(self.order) - head)))
            block[number[i:j], place[i:j] - head] = weight[i:j]
            self.blocks.append(block)
        self.most = np.stack([b.max(axis=1) for b in self.blocks], axis=1) if self.n_common else np.zeros((0, len(self.blocks)))

    def nearest(self, query, k: int, without: int = -1) -> list[tuple[float, int]]:
        """:meth:`nearest_of` one vector."""
        return self.nearest_of([query], k, [without])[0]

    def nearest_of(self, queries: list, k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each vector up to k (cosine, example) with cosine above 0, best first, ties by example;
        ``without``: an example that each vector leaves out."""
        n, m = len(self.order), len(queries)
        if not n or not m:
            return [[] for _ in queries]
        if self.blocks is None:
            self._open()
        cosine, common, steps = np.zeros((m, n)), np.zeros((m, self.n_common)), np.arange(1 << 16)
        for q, vector in enumerate(queries):
            term, weight = _arrays(vector)
            number = self.common[term]
            rare = number < 0
            common[q, number[~rare]] = weight[~rare]
            first = self.cuts[term[rare]]
            size = self.cuts[term[rare] + 1] - first
            first = first.astype(np.int64)
            at = np.repeat(first - np.cumsum(size) + size, size)
            if len(at) > len(steps):
                steps = np.arange(2 * len(at))
            at += steps[:len(at)]
            products = self.weights.take(at, mode="clip")  # all within: no check of every index
            products *= np.repeat(weight[rare], size)
            cosine[q] = np.bincount(self.places.take(at, mode="clip"), products, n)
        bounds = np.maximum.reduceat(cosine, self.heads, axis=1) + common @ self.most
        opened = np.zeros(bounds.shape, bool)
        first = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
        due = np.zeros(bounds.shape, bool)
        np.put_along_axis(due, first, True, axis=1)
        for _ in range(2):
            for b, head in enumerate(self.heads.tolist()):
                rows = np.flatnonzero(due[:, b])
                if len(rows) * 5 > m * 3:   # rather too many products than a copy of most rows
                    cosine[rows, head:head + BLOCK] += (common @ self.blocks[b])[rows]
                elif len(rows):
                    cosine[rows, head:head + BLOCK] += common[rows] @ self.blocks[b]
            opened |= due
            found = np.where(np.repeat(opened, np.diff(np.append(self.heads, n)), axis=1), cosine, -1.0)
            keep = min(k + (without is not None), n)  # one more where one is left out
            kth = np.partition(found, n - keep, axis=1)[:, n - keep]
            due = ~opened & (bounds * (1 + 1e-9) + 1e-9 >= kth[:, None]) & (bounds > 0)
            if not due.any():
                break
        out = []
        for q in range(m):
            some = np.flatnonzero(found[q] >= max(kth[q] - 1e-9, 1e-300))
            best = [(min(1.0, c), i) for c, i in zip(np.round(found[q, some], PLACES).tolist(), self.order[some].tolist())
                    if c > 0 and (without is None or i != without[q])]
            out.append(sorted(best, key=lambda x: (-x[0], x[1]))[:k])
        return out


class Model:
    """Terms, weights, examples, their index and the fitted scale."""

    def __init__(self, vocabulary: Vocabulary, idf: np.ndarray, examples: list, rows_of: dict[int, int]):
        """``examples``: (id, label, term numbers, counts)."""
        self.vocabulary = vocabulary
        self.idf = np.array(idf, float)
        self.ids = [e[0] for e in examples]
        self.labels = [e[1] for e in examples]
        held = Counter(self.labels)
        n = sum(rows_of.values())
        self.share = [rows_of.get(y, 0) / max(1, held[y]) for y in (0, 1)]
        self.prior = rows_of.get(1, 0) / n if n else 0.5
        self.mean_share = sum(self.share) / 2 or 1.0
        vectors = [self.weighted(*e[2:]) for e in examples]
        self.index = BlockMaxIndex(vectors, vocabulary.size)
        self.steps = ([0.0, 1.0], [0.0, 1.0])
        if held[0] and held[1]:
            raw = []
            for i in range(0, len(vectors), BATCH_TEXTS):
                some = range(i, min(i + BATCH_TEXTS, len(vectors)))
                raw += map(self._raw, self.index.nearest_of(vectors[i:i + BATCH_TEXTS], NEIGHBOURS, list(some)))
            self.steps = isotonic(raw, self.labels, [self.share[y] for y in self.labels])
            self.index.blocks = None

    def weighted(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(counts)) * self.idf[terms]
        return terms, w / math.sqrt(w @ w) if len(w) else w

    def _raw(self, found: list[tuple[float, int]]) -> float:
        votes = [0.0, 0.0]
        for cosine, i in found:
            y = self.labels[i]
            votes[y] += self.share[y] / (1 + SHARP - cosine)
        extra = PRIOR * self.mean_share
        return (votes[1] + extra * self.prior) / (sum(votes) + extra)

    def score(self, text: bytes | None) -> tuple[float, list[tuple[float, int]]]:
        """:meth:`scores` of one text."""
        scores, found = self.scores([text or b""])
        return float(scores[0]), found[0]

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[float, int]]]]:
        """The score of each text, and its nearest examples; equal texts are scored once."""
        place: dict[bytes, int] = {}
        at = [place.setdefault(t, len(place)) for t in texts]
        distinct, found = list(place), []
        for i, j in _batches(distinct):
            found += self.index.nearest_of([self.weighted(*c) for c in self.vocabulary.counts(distinct[i:j])], NEIGHBOURS)
        scores = np.interp([self._raw(f) for f in found], *map(np.array, self.steps))
        return scores[at], [found[i] for i in at]


def isotonic(raw: list[float], labels: list[int], weights: list[float]) -> tuple[list[float], list[float]]:
    """Knots of a non-decreasing map from raw votes to the share of label 1."""
    pools: list[list[float]] = []  # lowest raw, highest raw, weighted labels, weight
    for x, y, w in sorted(zip(raw, labels, weights)):
        if pools and x == pools[-1][1]:
            pools[-1][2] += y * w
            pools[-1][3] += w
        else:
            pools.append([x, x, y * w, w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, s, w1 = pools.pop()
            pools[-1][1], pools[-1][2], pools[-1][3] = high, pools[-1][2] + s, pools[-1][3] + w1
    xs, ys = [], []
    for low, high, s, w in pools:
        for x in dict.fromkeys((low, high)):
            xs.append(x)
            ys.append(s / w)
    return xs, ys


def held_out(key: str):
    """Whether a row is kept from all learning."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _new(terms: pa.Array) -> np.ndarray:
    """Whether each term is another than the one before it."""
    if not len(terms):
        return np.zeros(0, bool)
    return np.concatenate(([True], pc.not_equal(terms.slice(1), terms.slice(0, len(terms) - 1)).to_numpy(False)))


def _smallest(train: DataFrame, y: int, texts: int) -> list:
    """The ``EXAMPLES`` smallest digests of a class. Digests are uniform, so those below a
    bound that some four times as many fall under are enough; few rows pass it in any task."""
    own, share = train.where(F.col("y") == y), 4 * EXAMPLES / texts
    place = F.conv(F.substring("digest", 1, 12), 16, 10).cast("double") / 16 ** 12
    while True:
        found = own.where(place < share).orderBy("digest").limit(EXAMPLES).collect()
        if len(found) == EXAMPLES or share >= 1:
            return found
        share *= 4


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> Model:
    """Learn from the labelled rows of ``df`` that are not held out.

    Only (key, hash) pairs are joined to the labels; texts are fetched for the
    chosen examples alone, whose number is bounded. Rows labelled null and null
    keys are not labelled. Without labelled rows of
    both classes every score is the prior (0.5 without any). A row labelled 0 and 1 counts
    for both classes.
    """
    spark = df.sparkSession
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(batch))
    spark.conf.set(batch, str(min(rows, ARROW_ROWS) if rows > 0 else ARROW_ROWS))
    raw = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)").distinct()
    keyed = df.where(~held_out(key)).select(F.col(key).alias("key"), F.sha2(raw, 256).alias("digest"))
    train = keyed.join(known, "key").groupBy("y", "digest").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    train = train.persist()
    try:
        sizes = train.groupBy("y").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
        rows_of = {r.y: r.n for r in sizes}
        chosen = [(r.y, r.digest, r.key) for s in sorted(sizes) for r in _smallest(train, s.y, s.texts)]
    finally:
        train.unpersist()
    kept = sorted(d for _, d, _ in chosen) if len(rows_of) == 2 else []  # one class alone has no terms

    def counted(batches):
        # the chosen texts as (digest, term, count); copies of a text come out alike
        for b in batches:
            d, w, n = [], [], []
            for digest, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_term: Counter = Counter()
                for word, c in Counter(words(t)).items():
                    for term in features(word):
                        by_term[term] += c
                d += [digest] * len(by_term)
                w += by_term.keys()
                n += by_term.values()
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.string()), pa.array(w, pa.binary()),
                                              pa.array(n, pa.int64())], ["digest", "term", "n"])

    digests = spark.createDataFrame(pa.table({"digest": pa.array(kept, pa.string())}))
    holders = spark.createDataFrame([(k,) for _, _, k in chosen if kept], f"key {df.schema[key].dataType.simpleString()}")
    # at most 2 x EXAMPLES keys; of their rows, those with a chosen text
    picked = (df.select(F.col(key).alias("key"), raw.alias("text")).join(F.broadcast(holders.distinct()), "key", "left_semi")
              .select(F.sha2("text", 256).alias("digest"), "text").join(F.broadcast(digests), "digest", "left_semi"))
    found = (picked.mapInArrow(counted, "digest string, term binary, n long").repartition("term")
             .groupBy("digest", "term").agg(F.max("n").cast("int").alias("n")))
    classes = spark.createDataFrame(pa.table({"digest": pa.array([d for _, d, _ in chosen], pa.string()),
                                              "i": pa.array(range(len(chosen)), pa.int32())}))

    def packed(batches):
        # the (example, count) pairs of each term as one binary value; a term may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            t = b.column(0)
            new = np.flatnonzero(_new(t))
            held = np.stack([b.column(1).to_numpy(), b.column(2).to_numpy()], axis=1).astype(np.int32)
            cuts = np.append(new, len(t)).astype(np.int32) * 8
            pairs = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(cuts), pa.py_buffer(held.tobytes())])
            yield pa.RecordBatch.from_arrays([t.take(pa.array(new)), pairs], ["term", "held"])

    # all terms of the examples, each with the examples that hold it
    listed = (found.join(F.broadcast(classes), "digest").select("term", "i", "n").sortWithinPartitions("term")
              .mapInArrow(packed, "term binary, held binary").toArrow())
    listed = listed.take(pc.sort_indices(listed.column("term"))).combine_chunks()
    names, lists = (listed.column(c).combine_chunks() for c in ("term", "held"))
    cuts, data = (np.frombuffer(x, np.int32) if x else np.zeros(1, np.int32) for x in lists.buffers()[1:])
    cuts = cuts[lists.offset:lists.offset + len(lists) + 1]
    new = np.flatnonzero(_new(names))
    vocabulary = Vocabulary(names.take(pa.array(new)).to_pylist())
    t = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(np.append(cuts[new], cuts[-1])) >> 3)
    own, n = data[cuts[0] >> 2:cuts[-1] >> 2].reshape(-1, 2).T
    order = np.argsort(own.astype(np.int16 if len(chosen) < 1 << 15 else np.int32), kind="stable").astype(np.int32)  # by example; its terms stay ascending
    at = np.searchsorted(own[order], np.arange(1, len(chosen)))
    counts = list(zip(np.split(t[order], at), np.split(n[order], at)))
    del listed, names, lists, cuts, data, new, own, t, n, order
    pa.default_memory_pool().release_unused()

    at = spark.sparkContext.broadcast(vocabulary)

    def held(batches):
        v = at.value
        n = np.zeros(v.size + 1, np.int64)
        for b in (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS)):
            texts = b.column(0).to_pylist()
            for i, j in _batches(texts):
                n[:-1] += np.bincount(v.held(texts[i:j]), minlength=v.size)
            n[-1] += b.num_rows
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["t", "n"])

    held_by = (df.select(raw.alias("text")).mapInArrow(held, "t long, n long")
               .groupBy("t").agg(F.sum("n").alias("n")).toArrow())
    at.destroy()
    rows = np.zeros(vocabulary.size + 1)
    rows[held_by.column("t").to_numpy()] = held_by.column("n").to_numpy()
    idf = np.log((1 + rows[-1]) / (1 + rows[:-1])) + 1
    return Model(vocabulary, idf, [(k, y, *c) for (y, _, k), c in zip(chosen, counts)], rows_of)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: the key) of every row with held_out, score,
    predicted (score >= ``REJECT``) and evidence: its nearest examples as
    (id, label, cosine).

    A null text is the empty text; it and texts without terms get the prior.
    Rows keep their number; other columns of these names are replaced."""
    carry = [c for c in (carry or [key]) if c not in ("held_out", "score", "predicted", "evidence")]
    kind = df.schema[key].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)
    own = [] if text in carry else [F.col(text).cast("string").alias("__text")]
    columns = df.select(*[F.col(c) for c in carry], held_out(key).alias("held_out"), *own)
    at = carry.index(text) if text in carry else len(carry) + 1
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches):
        m = sent.value
        for b in (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS)):
            scores, found = m.scores([(x or "").encode() for x in b.column(at).to_pylist()])
            flat = [e for one in found for e in one]
            id_type = b.column(carry.index(key)).type if key in carry else pa.int64()
            nearest = pa.StructArray.from_arrays(
                [pa.array([m.ids[i] for _, i in flat], id_type), pa.array([m.labels[i] for _, i in flat], pa.int32()),
                 pa.array([c for c, _ in flat], pa.float64())], ["id", "label", "cosine"])
            evidence = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), nearest)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(carry) + 1], pa.array(scores), pa.array((scores >= REJECT).astype(np.int32)), evidence],
                [*carry, "held_out", "score", "predicted", "evidence"])
    return columns.mapInArrow(
        run, f"{fields}, held_out boolean, score double, predicted int,"
             f" evidence array<struct<id:{kind},label:int,cosine:double>>")
