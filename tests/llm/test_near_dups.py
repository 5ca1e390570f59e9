"""Near-duplicate operators against brute force, and their edge cases."""

import math
import random

import numpy as np
import pytest
import xxhash

from fleetscope.llm import embeddings as E
from fleetscope.llm import simhash as H
from fleetscope.llm.components import components

SF01 = "/root/testdata/sf0.01"


def union_find(n, pairs):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return [root(i) for i in range(n)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (9, 9), (5, 6)]
    random.Random(3).shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def naive_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hs) * 2 > len(hs))


def simhash_expected(rows, k=3):
    fps = [naive_fingerprint(t, k) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = union_find(len(rows), pairs)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f, least.get(r)) for (d, _), f, r in zip(rows, fps, roots)), key=str)


def test_simhash_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in H.near_duplicates(docs).collect()), key=str)
    assert got == simhash_expected(rows)


def test_simhash_hash_is_the_engine_s(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] == int(
        np.uint64(xxhash.xxh64_intdigest(b"a b c", 42)).astype(np.int64))


def test_simhash_edges_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (5, "a B"), (None, "a b"), (6, "É é"),
            (7, "x " * 40000), (8, "\x1c ")]
    df = spark.createDataFrame([(d, t, 9, 9) for d, t in rows], "doc_id long, text string, fp int, component_id int")
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in H.near_duplicates(df).collect()), key=str)
    assert got == simhash_expected(rows)
    assert H.near_duplicates(df.limit(0)).collect() == []


def test_simhash_long_posting_list_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:
        x = rnd.choice(sorted(fps))
        for _ in range(rnd.choice([1, 2, 4])):
            x ^= 1 << rnd.randrange(24)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in map(tuple, H.links(df).collect())]
    at = {f: i for i, f in enumerate(fps)}
    want = union_find(len(fps), [(i, j) for i in range(len(fps)) for j in range(i)
                                 if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert union_find(len(fps), [(at[a], at[b]) for a, b in pairs]) == want


def cosine_expected(rows, threshold=0.93):
    ok = [v is not None and l is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v, l in rows]
    vs = [np.array(v, float) / max(map(abs, v)) if o else None for (_, v, _), o in zip(rows, ok)]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(vs[i]) == len(vs[j]):
                if vs[i] @ vs[j] / math.sqrt((vs[i] @ vs[i]) * (vs[j] @ vs[j])) >= threshold - 1e-12:
                    pairs.append((i, j))
    roots = union_find(len(rows), pairs)
    least, n = {}, [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for (d, *_), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, n[i], least.get(roots[i]), d == least.get(roots[i])) for i, (d, *_) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_embeddings_match_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in df.collect()]
    assert result(E.near_duplicates(df)) == cosine_expected(rows)


@pytest.mark.parametrize("block,kind", [(8, "float"), (1024, "float"), (1024, "double")])
def test_embeddings_edges_copies_and_blocks(spark, monkeypatch, block, kind):
    monkeypatch.setattr(E, "BLOCK", block)
    rnd = np.random.default_rng(2)
    base = rnd.standard_normal(8)
    rows = [(i, (base + 0.1 * rnd.standard_normal(8)).tolist(), i % 2) for i in range(60)]
    rows += [(100 + i, base.tolist(), 1) for i in range(30)]           # copies
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 8, 1), (203, [math.nan] * 8, 1), (204, [None] * 8, 1),
             (205, base.tolist(), None), (206, [math.inf] * 8, 0), (None, base.tolist(), 1), (0, rows[0][1], 0),
             (207, [1e30] * 8, 0), (208, [1e-30] * 8, 0), (209, [1.0], 0), (210, [2.0], 0)]
    if kind == "double":   # beyond floats, and apart only as doubles
        rows += [(300, [1e39, 1.0], 3), (301, [1e39, 1.0], 3), (302, [1e39, 2.0], 3), (303, [1.0, 1e-46], 4), (304, [1.0, 2e-46], 4),
                 (305, [1e-320, 1e-320], 4), (306, [1.0, 0.39523], 5), (307, [1.0, 0.0], 5), (308, [1.0, 0.39522], 5)]
    else:
        rows = [(d, v and [None if x is None else float(np.float32(x)) for x in v], y) for d, v, y in rows]
    df = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, cid int")
    got = result(E.near_duplicates(df, tables=60))
    assert got == cosine_expected(rows)
    if kind == "double":
        found = {g[0]: g for g in got}
        assert found[300][1:3] == (2, 300) and found[303][1] == 1
    assert E.near_duplicates(df.limit(0)).collect() == []


def test_embeddings_recall_on_a_larger_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in df.collect()]
    want = sum(r[1] for r in cosine_expected(rows))
    got = sum(r.n_links for r in E.near_duplicates(df).collect())
    assert 0.99 * want <= got <= want
