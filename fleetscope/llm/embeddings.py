"""Embedding near-duplicates: random-hyperplane sign hashing in several tables.

Equal vectors with equal labels are one class, found by a pre-aggregated
group-by, so copies never meet. Each class is hashed by the signs of its
products with random hyperplanes, once for each table; classes that share a
code in some table are compared by exact cosine in double precision. A pair is
counted only in the first table in which its codes agree, so link counts need
no list of pairs. Buckets are compared in blocks (see ``blocks``): matrix
products whose results are a count for each class and a spanning forest.

With ``BITS`` 10 and ``TABLES`` 20 a pair at cosine 0.93 is met with
probability 1 - (1 - (1 - acos(0.93) / pi) ** 10) ** 20 = 0.998, more above.
The vectors are sent once for each table; that is the price for comparing
without any list of candidate pairs. A bucket holds about 1 / 2 ** bits of a
label and is compared whole, so for labels of far more than a million distinct
vectors raise ``bits`` by one for each doubling, and ``tables`` to keep the
recall that the formula gives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.blocks import compared, forest
from fleetscope.llm.common import written
from fleetscope.llm.components import components

TABLES = 20
BITS = 10
BLOCK = 1024
SEED = 20240229


def _finite(v: Column) -> Column:
    """Not null, not zero, without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix of doubles."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _hashed(tables: int, bits: int, seed: int):
    planes: dict[int, np.ndarray] = {}

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            codes = np.zeros((b.num_rows, tables), np.int32)
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                own = np.flatnonzero(dims == dim)
                v = _matrix(b.column("v").take(pa.array(own)))
                signs = (v / np.abs(v).max(axis=1, keepdims=True)) @ planes[dim] > 0
                codes[own] = signs.reshape(-1, tables, bits) @ (1 << np.arange(bits))
            lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, tables, dtype=np.int32), codes.ravel())
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "codes"])
    return run


def _unit(threshold: float):
    def unit(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        column = lambda c: table.column(c).to_numpy()
        cid, mult, block = column("cid"), column("mult"), column("__block")
        v = _matrix(table.column("v").combine_chunks())
        codes = _matrix(table.column("codes").combine_chunks()).astype(np.int32)
        lo, hi, blocks, t = (column(c)[0] for c in ("__lo", "__hi", "__n", "t"))
        v /= np.abs(v).max(axis=1, keepdims=True)  # keeps the squares in range
        v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
        linked = v @ v.T >= threshold
        np.fill_diagonal(linked, False)
        # counted once: where the codes first agree, and in one of the units that hold both
        for before in range(t):
            linked &= codes[:, before, None] != codes[None, :, before]
        if blocks > 1:
            for b, here in ((lo, hi == lo + 1), (hi, hi == blocks - 1 and lo == hi - 1)):
                if not here:
                    own = block == b
                    linked[np.ix_(own, own)] = False
        counts = linked @ mult
        some = np.flatnonzero(counts)
        edges = np.array(forest(linked), np.int64).reshape(-1, 2)
        a = np.concatenate((cid[some], cid[edges[:, 0]]))
        b = pa.array(np.concatenate((cid[some], cid[edges[:, 1]])))
        links = np.concatenate((counts[some], np.zeros(len(edges), np.int64)))
        assert n >= 2
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(links)], ["a", "b", "links"])
    return unit


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93, tables: int = TABLES, bits: int = BITS,
                    seed: int = SEED) -> DataFrame:
    """(key, n_links, component_id, kept) for each row.

    Rows link if their labels are equal and not null, their vectors have the
    same length and their cosine, in double precision, is ``threshold`` or more. Vectors
    keep their element type: float stays float, all other numbers become doubles. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing.
    ``n_links`` counts the other rows linked directly, repeated rows included;
    ``component_id`` is the smallest key that can be reached; ``kept`` tells
    whether it is the row's own. Other columns are ignored; no rows give none.
    """
    element = "float" if df.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast(f"array<{element}>").alias("v"),
                     F.col(label).alias("label"))
    rows = rows.withColumn("ok", _finite(F.col("v")) & F.col("label").isNotNull())
    classes = written(
        rows.where("ok").groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("mult"))
        .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    kind = classes.schema["label"].dataType.simpleString()
    hashed = classes.select("cid", "mult", "label", F.size("v").alias("dim"), "v").mapInArrow(
        _hashed(tables, bits, seed),
        f"cid long, mult long, label {kind}, dim int, v array<{element}>, codes array<int>")
    members = hashed.select("*", F.posexplode("codes").alias("table", "code")).withColumn("t", F.col("table"))
    found = written(compared(members, ["table", "code", "label", "dim"], "cid", BLOCK,
                             "a long, b long, links long", _unit(threshold)), "vector-links")
    counts = found.where("a = b").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(found.where("a != b").select("a", "b"))
    named = (classes.join(counts, "cid", "left")
             .join(roots, classes.cid == roots.node, "left")
             .select("label", "v", "rep", F.coalesce("root", "cid").alias("root"),
                     (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    named = named.join(least, "root").select(F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "least")
    joined = rows.join(named, F.col("ok") & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("least", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
