"""Exact repeat operators and language-model scores against brute force."""

import hashlib
import random

import pytest

from fleetscope.llm import chunks
from fleetscope.llm import lm_scores as L
from fleetscope.llm import substrings as U
from fleetscope.llm import suffixes as S

SF01 = "/root/testdata/sf0.01"


def bytes_removed(rows, length):
    """Covered bytes of each row by brute force over all strings."""
    least = {}
    key = lambda d: (d is None, d)
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            g = b[i:i + length]
            if g not in least or key(d) < least[g]:
                least[g] = key(d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < key(d):
                gone[i:i + length] = b"\1" * length
        spans = [m for m in gone.split(b"\0") if m]
        out.append((d, len(b), sum(gone), len(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def suffix_result(df, **kw):
    return sorted(((r[0], r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept))
                   for r in S.repeats_removed(df, **kw).collect()), key=str)


def test_suffix_dedup_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    assert suffix_result(df) == bytes_removed([tuple(r) for r in df.collect()], 50)


def made_up(seed, n=60):
    rnd = random.Random(seed)
    letters = ["a", "b", "é", "\0", " ", "漢"]
    shared = ["".join(rnd.choice(letters) for _ in range(rnd.randint(10, 90))) for _ in range(8)]
    rows = []
    for d in range(n):
        parts = [rnd.choice(shared) if rnd.random() < .6 else "".join(rnd.choice(letters) for _ in range(30))
                 for _ in range(rnd.randint(0, 6))]
        rows.append((d, "".join(parts)))
    rows += [(n, None), (n + 1, ""), (None, rows[5][1]), (None, rows[5][1]), (3, rows[3][1]), (n + 2, "ab" * 2000),
             (n + 3, "ab" * 1500), (n + 4, "\0" * 300), (n + 5, "\0" * 200), (n + 6, rows[7][1]), (n + 7, rows[7][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,chunk,segment", [(1, 8 << 20, 1 << 20), (2, 400, 1 << 20), (3, 2000, 97)])
def test_suffix_dedup_edges_and_chunks(spark, monkeypatch, seed, chunk, segment):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "SEGMENT", segment)
    rows = made_up(seed)
    df = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, chunk int, kept binary")
    assert suffix_result(df.repartition(3)) == bytes_removed(rows, 50)
    assert suffix_result(df, length=20, gram=8) == bytes_removed(rows, 20)
    assert S.repeats_removed(df.limit(0)).collect() == []


def test_a_hot_anchor_is_dealt_to_many_buckets(spark):
    import pyarrow as pa
    rnd = random.Random(5)
    side = lambda: "".join(rnd.choice("abcdefgh") for _ in range(20))
    rows = [(d, f"{side()}One line that very many of the documents hold.. {side()}") for d in range(4500)]
    a = S._Anchored(pa.table({"key": [d for d, _ in rows], "text": [t.encode() for _, t in rows]}), 50, 24)
    dealt, two = S._ask_anchors(a, 64)
    answers = {(1, b): S._repeated([q])[0] for b, q in S._asked(dealt, two).items()}
    most = {split: max(map(len, S._Stretches(a, answers, 64, 50, split).of.values())) for split in (False, True)}
    assert most[True] < S.HOT < most[False]  # an anchor of fewer places stays whole
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert suffix_result(df) == bytes_removed(rows, 50)


def test_maximal_repeat_groups_hold_all_occurrences(spark):
    rows = list(dict(r for r in made_up(4) if r[0] is not None).items())  # each id once
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [(d, (t or "").encode()) for d, t in rows]
    found = {}
    for r in S.maximal_repeats(df).collect():
        found.setdefault(bytes(r.group), set()).add((r.doc_id, r.start))
    assert found
    for group, at in found.items():
        assert len(group) >= 50
        want = {(d, i) for d, b in texts for i in range(len(b)) if b.startswith(group, i)}
        assert at <= want and (len(want) > 1)
    # every repeated string of 50 bytes that two rows hold lies in some occurrence of a group
    covered = {}
    for group, at in found.items():
        for d, i in at:
            covered.setdefault(d, set()).update(range(i, i + len(group) - 49))
    rows_of = {}
    for d, b in texts:
        for i in range(len(b) - 49):
            rows_of.setdefault(b[i:i + 50], set()).add(d)
    assert all(i in covered.get(d, ()) for d, b in texts for i in range(len(b) - 49) if len(rows_of[b[i:i + 50]]) > 1)


def test_suffix_tree_intervals():
    texts = [b"x" * 3 + b"banana", b"y" + b"banana" + b"s", b"banan" + b"q"]
    import numpy as np

    from fleetscope.llm.rolling import pack_any
    ask = chunks.frame(np.array([len(t) - 2 for t in texts], np.uint16).tobytes(), b"".join(texts),
                       pack_any(np.array([5, 3, 4])), pack_any(np.array([1, 1, 1])))
    b = S.SuffixBucket([ask], 3)
    got = {(lcp, b.texts[b.stretch[i]][b.offset[i]:b.offset[i] + lcp]): j - i + 1 for lcp, i, j, _ in b.intervals()}
    assert got[5, b"banan"] == 3 and got[6, b"banana"] == 2 and got[3, b"ana"] == 5 and got[5, b"anana"] == 2
    outer = {bytes(b.texts[b.stretch[i]][b.offset[i]:b.offset[i] + 3]) for _, i, _, o in b.intervals() if o}
    assert outer == {b"ban", b"ana", b"nan"}


def words_removed(rows, window=20):
    key = lambda d: (d is None, d)
    least = {}
    split = [[w for w in (t or "").encode().split()] for _, t in rows]
    for (d, _), w in zip(rows, split):
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if g not in least or key(d) < least[g]:
                least[g] = key(d)
    out = []
    for (d, _), w in zip(rows, split):
        gone, seen = [0] * len(w), set()
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if least[g] < key(d) or g in seen:
                gone[i:i + window] = [1] * window
            seen.add(g)
        out.append((d, len(w), sum(gone), b" ".join(x for x, r in zip(w, gone) if not r).decode()))
    return sorted(out, key=str)


def window_result(df, **kw):
    return sorted(((r[0], r.n_words, sum(s.stop - s.start for s in r.spans), r.kept)
                   for r in U.repeats_removed(df, **kw).collect()), key=str)


def test_substring_dedup_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    assert window_result(df) == words_removed([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("seed,chunk", [(1, 8 << 20), (2, 300)])
def test_substring_dedup_edges_and_chunks(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk)
    rnd = random.Random(seed)
    shared = [[rnd.choice("abcdé") for _ in range(rnd.randint(5, 60))] for _ in range(6)]
    rows = []
    for d in range(50):
        words = [w for _ in range(rnd.randint(0, 6)) for w in (rnd.choice(shared) if rnd.random() < .7 else [str(rnd.random())])]
        rows.append((d, rnd.choice([" ", "\n", "\t\x0b "]).join(words)))
    rows += [(60, None), (61, ""), (62, " \n"), (None, rows[4][1]), (None, rows[4][1]), (4, rows[4][1]), (63, "a " * 3000),
             (64, "A " * 25), (65, "x\x1cy z " * 30)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n_words int, kept string")
    assert window_result(df.repartition(3)) == words_removed(rows)
    assert window_result(df, window=7, block=3) == words_removed(rows, 7)
    assert U.repeats_removed(df.limit(0)).collect() == []


def lm_expected(rows, order, alpha=0.4):
    from collections import Counter
    from math import log
    docs = [(t or "").encode().lower().split() for _, t in rows]
    grams = [Counter(tuple(w[i:i + o]) for o in range(1, order + 1) for i in range(len(w) - o + 1)) for w in docs]
    total = sum(grams, Counter())
    n = sum(map(len, docs))
    out = []
    for (d, _), w, own in zip(rows, docs, grams):
        score, back = 0.0, 0
        for i in range(len(w)):
            for o in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - o + 1:i + 1])
                c = total[g] - own[g]
                if o == 1:
                    score += log(max(c, 1) / max(n - len(w), 1))
                elif c > 0:
                    score += log(c / (total[g[:-1]] - own[g[:-1]]))
                    break
                else:
                    score, back = score + log(alpha), back + 1
        out.append((d, len(w), round(score, 6), back))
    return sorted(out, key=str)


@pytest.mark.parametrize("order,chunk", [(1, 8 << 20), (2, 200), (3, 8 << 20), (4, 500)])
def test_lm_scores_match_brute_force(spark, monkeypatch, order, chunk):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", chunk)
    rnd = random.Random(order)
    rows = [(d, " ".join(rnd.choice("aAbcde") for _ in range(rnd.randint(0, 40)))) for d in range(40)]
    rows += [(50, None), (51, ""), (None, "a b c"), (1, rows[1][1]), (52, "zzz a b"), (53, "q " * 2000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_words int")
    got = sorted(((r.doc_id, r.n_words, round(r.log_score, 6), r.n_backoff) for r in L.scores(df, order=order).collect()), key=str)
    want = lm_expected(rows, order)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-5 for g, w in zip(got, want))
    assert L.scores(df.limit(0)).collect() == []


def test_a_registered_query_backs_off_from_trigrams(spark, tmp_path):
    from fleetscope.llm.queries import QUERIES
    rnd = random.Random(9)
    rows = [(d, " ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 30)))) for d in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op5_lm_scores_order3"](spark, str(tmp_path)).collect()), key=str)
    want = lm_expected(rows, 3)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want] and want != lm_expected(rows, 2)
    assert all(abs(g[2] - w[2]) < 1e-5 for g, w in zip(got, want))


def test_kept_bytes_digest(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    r = S.repeats_removed(df).first()
    assert hashlib.sha256(bytes(r.kept)).hexdigest() == hashlib.sha256(b"abc").hexdigest()
