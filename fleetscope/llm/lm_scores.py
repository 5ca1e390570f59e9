"""Language-model scores by stupid backoff over n-gram count tables.

The n-grams of all orders are counted in tables partitioned by their hash. The
documents' exploded n-grams, distinct and counted for each chunk of documents,
are joined to those tables (see ``chunks``: the packed rows of a bucket hold
its n-grams with their counts; the join returns the totals in the same order), and the
scores are summed for each document.

A document is scored by the counts of all other rows: its own are subtracted.
The score of a word is log(count(context word) / count(context)) for the
longest context with a positive count, with log(``BACKOFF``) for each step to a
shorter one; below that it is log(count(word) / words), a word that no other row has
counting once. Counting covers the whole corpus; nothing is pruned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetscope.llm import chunks
from fleetscope.llm.rolling import Words, pack, pack_any, slice_hashes, unpack, unpack_any

ORDER = 2
BACKOFF = 0.4
#: Stands for the number of words.
_ALL_WORDS = np.uint64(0)


class _Grams:
    """The n-grams of a chunk, dealt to buckets, with their counts."""

    def __init__(self, table: pa.Table, order: int, n: int):
        self.words = w = Words([t.lower() for t in table.column("text").to_pylist()])  # bytes: A-Z only
        self.at = [w.windows(o) for o in range(1, order + 1)]
        parts = [slice_hashes(w.data, w.starts[at], w.stops[at + o]) for o, at in enumerate(self.at)]
        self.dealt = chunks.Dealt(np.concatenate([np.array([_ALL_WORDS]), *parts]), n)
        self.counts = np.bincount(self.dealt.item, minlength=self.dealt.n_items)
        self.all_words = self.dealt.item[0]
        self.counts[self.all_words] = len(w.doc)
        cuts = np.cumsum([1, *map(len, parts)])
        self.items = [self.dealt.item[i:j] for i, j in zip(cuts[:-1], cuts[1:])]


def _totals(asks: list[bytes]) -> list[bytes]:
    parts = [chunks.unframe(a) for a in asks]
    values = [unpack(p[0]) for p in parts]
    counts = np.concatenate([unpack_any(p[1], len(v)) for p, v in zip(parts, values)])
    every, item = np.unique(np.concatenate(values), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, item, counts.astype(np.int64))
    cuts = np.cumsum([len(v) for v in values])[:-1]
    return [pack_any(x) for x in np.split(total[item], cuts)]


def _scored(g: _Grams, total: np.ndarray, order: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word, and the steps taken to shorter contexts."""
    w = g.words
    words = len(w.doc)
    own = []  # how often the document itself has the n-gram
    for at, item in zip(g.at, g.items):
        _, place, n = np.unique(w.doc[at] * np.int64(g.dealt.n_items) + item, return_inverse=True,
                                return_counts=True)
        own.append(n[place])
    other = [total[item] - n for item, n in zip(g.items, own)]
    sizes = np.diff(w.first)
    rest = np.maximum(total[g.all_words] - sizes[w.doc], 1)
    score = np.log(np.maximum(other[0], 1) / rest)
    depth = np.ones(words, np.int64)        # orders that the place of the word allows
    reached = np.ones(words, np.int64)      # order that was used
    for o in range(2, order + 1):
        at = g.at[o - 1]
        last = at + o - 1
        depth[last] = o
        # the context is the n-gram of one order less that starts at the same word
        context = other[o - 2][np.searchsorted(g.at[o - 2], at)]
        seen = other[o - 1] > 0
        score[last[seen]] = np.log(other[o - 1][seen] / context[seen])
        reached[last[seen]] = o
    steps = depth - reached
    return score + steps * math.log(backoff), steps


def scores(df: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER,
           backoff: float = BACKOFF) -> DataFrame:
    """For each row: key, n_words, log_score (sum over its words, natural logs),
    n_backoff (steps to shorter contexts).

    Words are runs of anything but ASCII white space, A-Z lower-cased. Null and
    empty texts have no words and score 0. Rows are documents: repeated rows
    count for each other. Null keys are kept; no rows give none.
    """
    docs, n = chunks.staged(df, key, text)
    kind = docs.schema["key"].dataType.simpleString()

    def ask(table, _):
        g = _Grams(table, order, n)
        return {b: chunks.frame(pack(v), pack_any(g.counts[g.dealt.of[b]])) for b, v in g.dealt.values.items()}

    totals = chunks.asked(docs, ask, _totals, 1)

    def apply(table, answers):
        g = _Grams(table, order, n)
        total = g.dealt.gathered({b: unpack_any(answers[1, b], len(v)) for b, v in g.dealt.values.items()}, np.int64)
        score, steps = _scored(g, total, order, backoff)
        rows, first = table.num_rows, g.words.doc
        return pa.table({"key": table.column("key"), "n_words": pa.array(np.diff(g.words.first), pa.int64()),
                         "log_score": pa.array(np.bincount(first, weights=score, minlength=rows)),
                         "n_backoff": pa.array(np.bincount(first, weights=steps, minlength=rows).astype(np.int64))})

    return chunks.applied(docs, totals, apply, f"key {kind}, n_words long, log_score double, n_backoff long"
                          ).withColumnRenamed("key", key)
