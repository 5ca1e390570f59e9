"""License scans, periodic runs and the conversation trie against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from fleetscope.llm import conversations as C
from fleetscope.llm import licenses as L
from fleetscope.llm import periodic as P
from fleetscope.llm.queries import QUERIES, rebuilt

SF01 = "/root/testdata/sf0.01"
sha = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


# --- 11: license scans

def license_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def licenses_expected(text, templates):
    words = license_words(text)
    at = lambda p: [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    places, labels, score = set(), set(), 0.0
    for t in templates:
        body, keys = license_words(t.text), [license_words(k) for k in t.keys]
        for k in keys:
            places |= {(i, " ".join(k)) for i in at(k)}
        if all(at(k) for k in keys):
            labels.add(t.label)
            for k in keys:
                off = next(i for i in range(len(body)) if body[i:i + len(k)] == k)
                for s in at(k):
                    same = sum(0 <= s - off + i < len(words) and words[s - off + i] == w for i, w in enumerate(body))
                    score = max(score, same / len(body))
    return len(words), sorted(places), sorted(labels), score


def license_texts(seed, templates):
    rnd = random.Random(seed)
    vocabulary = sorted({w for t in templates for w in license_words(t.text)}) + ["été", "漢字", "7", "x"]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rnd.randint(0, 8)):
            t = rnd.choice(templates)
            parts.append(rnd.choice([t.text, t.text.upper(), rnd.choice(t.keys), " ".join(rnd.sample(vocabulary, 3)),
                                     " ".join(license_words(t.text)[rnd.randint(0, 3):])]))
        texts.append(rnd.choice([" ", "\n", "-", "_ "]).join(parts))
    return texts + [None, "", " \n", "MIT LICENSEmit license", "mit  License, mit license", "mit license " * 3000,
                    "license general public license public license"]


@pytest.mark.parametrize("seed", [1, 2])
def test_licenses_match_brute_force(spark, seed):
    texts = license_texts(seed, L.TEMPLATES)
    rows = [(i, t, 1, "a") for i, t in enumerate(texts)] + [(None, texts[0], 2, None), (3, texts[3], 3, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string")
    got = sorted(((r.doc_id, (r.n_words, [(p.start, p.phrase) for p in r.places], list(r.labels), r.score))
                  for r in L.scan(df.repartition(3)).collect()), key=str)
    # places at one start are ordered by the phrases' numbers: compare them as sets
    plain = lambda x: (x[0], (x[1][0], sorted(x[1][1]), *x[1][2:]))
    want = sorted(((d, licenses_expected(t, L.TEMPLATES)) for d, t, *_ in rows), key=str)
    assert sorted(map(plain, got), key=str) == sorted(map(plain, want), key=str)
    assert L.scan(df.limit(0)).collect() == []


def test_licenses_take_other_templates(spark):
    own = (L.Template("a", "a b a c", ("a b", "c")), L.Template("b", "zz", ("zz",)), L.Template("c", "a b a b x", ("a b a b",)))
    texts = ["a b a b a b", "c a b", "zz a", "b a", None, "a b a c"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, body string")
    got = {r.k: (r.n_words, sorted((p.start, p.phrase) for p in r.places), list(r.labels), r.score)
           for r in L.scan(df, "k", "body", own).collect()}
    assert got == {k: licenses_expected(t, own) for k, t in enumerate(texts)}
    with pytest.raises(ValueError):
        L.scan(df, "k", "body", (L.Template("a", "a b", ("b a",)),))


def test_license_phrases_are_looked_up_by_their_rarest_words():
    index = L._index(L.BASE, {"license": 90, "mit": 3, "apache": 4, "public": 8, "general": 8})
    assert [(p["rare"], p["at"], p["next"], p["next_at"]) for p in index] == [
        ("mit", 0, "license", 1), ("apache", 0, "license", 1), ("general", 0, "public", 1)]


# --- 12: periodic runs

def runs_expected(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 2 * q:
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items() if e - s >= max(least, 2 * q))


def run_texts(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(120):
        n = rnd.randint(0, 80)
        words = [rnd.choice(["a", "b", "é", "A", "c,"][:rnd.randint(1, 5)]) for _ in range(n)]
        if n and rnd.random() < .6:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, n // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append(rnd.choice([" ", "\n", "\t\x0b "]).join(words))
    return texts + [None, "", " \n", "x " * 12, "x " * 11, "w " * 20000, "a b " * 3000 + "c", "x\x1cy " * 30, "x y z " * 9]


@pytest.mark.parametrize("seed,piece,tested", [(1, 1 << 18, 1 << 21), (2, 100, 50), (3, 1, 7)])
def test_runs_match_brute_force(spark, monkeypatch, seed, piece, tested):
    monkeypatch.setattr(P, "PIECE_WORDS", piece)
    monkeypatch.setattr(P, "TESTED", tested)
    texts = run_texts(seed)
    rows = [(i, t, "r", 1) for i, t in enumerate(texts)] + [(None, texts[1], None, 2), (5, texts[5], "r", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")

    def expected(text):
        words = (text or "").encode().split()
        if len(set(words)) == 1 and len(words) > 1000:  # too long for brute force
            found = [(0, len(words), 1)]
        else:
            found = runs_expected(words) if len(words) < 1000 else [(0, 6000, 2)]
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        return len(words), found, " ".join(w.decode() for i, w in enumerate(words) if i not in gone)
    got = sorted(((r.doc_id, (r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in P.periodic_runs(df).collect()), key=str)
    assert got == sorted(((d, expected(t)) for d, t, *_ in rows), key=str)
    shorter = {r.doc_id: [tuple(x) for x in r.runs] for r in P.periodic_runs(df.where("doc_id < 100 AND doc_id != 5"), least=4).collect()}
    assert shorter == {d: runs_expected((t or "").encode().split(), 4) for d, t, *_ in rows if d is not None and d < 100 and d != 5}
    assert P.periodic_runs(df.limit(0)).collect() == []


def test_runs_of_the_registered_query(spark, tmp_root):
    rnd = random.Random(4)
    rows = [(d, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 90)))) for d in range(300)]
    rows += [(300, None), (301, ""), (None, "a b " * 12)] + [(d, None) for d in range(310, 330)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_root}/documents.parquet")
    want = []
    for d, t in rows:
        words, h = (t or "").split(), None if d is None else zlib.crc32(str(d).encode())
        n = len(words)
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs_expected(words)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append((d, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    got = QUERIES["op12_periodic_runs"](spark, tmp_root).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and sum(w[1] for w in want) > 10


# --- 13: conversation prefix trie

def trie_expected(paths):
    """paths: {conv: [(role, text)]}"""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items())


def trie_rows(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def made_up_turns(seed, n=80, deep=False):
    rnd = random.Random(seed)
    pool = [[(rnd.choice(["user", "assistant"]), rnd.choice(["", "é", "hello", "漢字", "x" * 500])) for _ in range(60)] for _ in range(3)]
    paths = {}
    for c in range(n):
        base = rnd.choice(pool)[:rnd.choice([0, 1, 2, 3, 8, 9, 16, 17, 20, 33, 60] if deep else [0, 1, 2, 3, 8])]
        paths[c - 5] = base + [("user", str(rnd.randint(0, 3))) for _ in range(rnd.randint(0, 3))]
    return paths


@pytest.mark.parametrize("seed,group_bytes", [(1, C.GROUP_BYTES), (2, 2000)])
def test_trie_matches_brute_force(spark, monkeypatch, seed, group_bytes):
    monkeypatch.setattr(C, "CHUNK", 3)
    paths = made_up_turns(seed, deep=True)
    rows = [(c, t, role, text, 1) for c, turns in paths.items() for t, (role, text) in enumerate(turns)]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, depth int")
    got = C.prefix_trie(C.turn_tokens(df), group_bytes=group_bytes)
    assert trie_rows(got) == trie_expected({c: p for c, p in paths.items() if p})
    nodes = {r.node: r for r in got.collect()}
    assert all((r.parent is None) == (r.depth == 0) and (not r.depth or nodes[r.parent].conv_id == r.parent_conv_id)
               for r in nodes.values())


def test_trie_edges(spark):
    rows = [(1, None, "user", "first"), (1, 2, "b", None), (1, 2, None, "tie"), (1, 2, "b", None), (2, 0, "user", "first"),
            (None, 0, "user", "first"), (3, 0, "", ""), (4, 0, None, None), (-7, 0, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    paths = {1: [("user", "first"), ("", "tie"), ("b", ""), ("b", "")], 2: [("user", "first")], -7: [("user", "first")],
             3: [("", "")], 4: [("", "")]}
    assert trie_rows(C.prefix_trie(C.turn_tokens(df.repartition(4)))) == trie_expected(paths)
    turnless = spark.createDataFrame([(1, []), (2, ["t" * C._DIGEST + "0" * C._BYTES]), (3, None), (None, [])], "conv_id long, tokens array<string>")
    assert trie_rows(C.prefix_trie(turnless)) == [(1, 0, None, 3, 1, 1, 0, sha("1,3")), (2, 1, 1, 1, 0, 1, 0, sha("2"))]
    empty = C.prefix_trie(C.turn_tokens(df.limit(0)))
    assert empty.collect() == [] and "ends_sha256" in empty.columns


def test_trie_bands_cover_every_depth(spark):
    ranges = [C._limits(b) for b in range(20)]
    assert [d for low, high in ranges for d in range(low, high + 1)] == list(range(ranges[-1][1] + 1))
    depths = spark.range(3000).select("id", C._band(C.F.col("id")).alias("band")).collect()
    assert all(ranges[r.band][0] <= r.id <= ranges[r.band][1] for r in depths)


def test_trie_of_the_registered_query(spark, tmp_root):
    paths = {c + 5: p for c, p in made_up_turns(7, 120).items() if p and (c % 5 or c % 2)}
    rows = [(c, t, role, text) for c, turns in paths.items() for t, (role, text) in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_root}/conversations.parquet")
    want = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = paths.get(c - c % 5, [])[:h] + own[h:]
    assert any(not p for p in want.values()) and trie_rows(QUERIES["op13_conversation_trie"](spark, tmp_root)) == trie_expected(want)
    tokens = spark.createDataFrame([], "conv_id long, tokens array<string>")
    assert rebuilt(tokens).collect() == []
