"""Prefix trie of conversations by truncation peeling.

A turn is a token of fixed width: a digest of role and text, and the text's bytes. A
conversation is its path, the tokens joined; a node is a distinct path. Peeling
descends from the greatest depth: the conversations that end there and the nodes
that survive from below are grouped by path, which makes them the nodes of this depth, with
all their sums; then the last token is stripped and the parents are
grouped with the conversations that end one turn earlier. Every depth is discovered and
summed in one step, copies and a common first turn collapse before the shuffle,
and each level is written to the shared folder, which cuts the lineage.

Depths up to ``SINGLE`` are levels of their own. Beyond, where few conversations are
left, a level is a band of depths that doubles (9-16, 17-32, ...): rows with the
same path at the band's lowest depth make a subtree, which a task peels turn by turn. A
subtree of more than ``GROUP_BYTES`` of paths is peeled by shuffles instead, depth by depth.
So the jobs grow with the logarithm of the greatest depth.

Memory: a task holds one subtree of a band. A conversation is one row, its path 44 bytes
a turn; texts never leave the task that reads them. The identifiers of a node's
own conversations are sorted by range, joined to strings of ``CHUNK`` of them where
they lie, and hashed string after string, so no list of them is ever held.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import shared_path, written

_DIGEST, _BYTES = 32, 12
TOKEN = _DIGEST + _BYTES
#: Depths that are levels of their own.
SINGLE = 8
#: Bytes of the paths in a subtree that one task peels.
GROUP_BYTES = 16 << 20
#: Identifiers joined to one string.
CHUNK = 512

_ROW = ["path", "conv", "n_convs", "n_children", "n_leaves", "saved"]


def turn_tokens(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """(conv, tokens) of each conversation: a token for each turn, in order.

    Turns are ordered by number, null first; equal numbers by role, then by the
    digest of role and text, so repeated rows are as many turns. Null roles and texts are
    empty. Rows of a null conversation belong to none. Other columns are ignored.
    """
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    token = F.concat(F.left(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256), F.lit(_DIGEST)),
                     F.lpad(F.hex(F.octet_length(said)), _BYTES, "0"))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), who.alias("role"), token.alias("token"))
    turns = rows.where("conv IS NOT NULL").groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "token"))).alias("turns"))
    return turns.select(F.col("conv").alias(conv), F.col("turns.token").alias("tokens"))


def _limits(band: int) -> tuple[int, int]:
    """The lowest and the greatest depth of a band."""
    if band <= SINGLE:
        return band, band
    lowest = SINGLE << (band - SINGLE - 1)
    return lowest + 1, 2 * lowest


def _band(depth: Column) -> Column:
    beyond = F.ceil(F.log2(depth / SINGLE)).cast("int")  # exact: a power of two has an exact logarithm
    return F.when(depth <= SINGLE, depth).otherwise(SINGLE + beyond).cast("int")


def _node(path: Column) -> Column:
    return F.unhex(F.sha2(path, 256))


def _stripped(path: str = "path") -> Column:
    return F.expr(f"left({path}, length({path}) - {TOKEN})")


def _regrouped(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth from their conversations and children."""
    last = F.conv(F.right("path", F.lit(_BYTES)), 16, 10).cast("long") if depth else F.lit(0).cast("long")
    nodes = rows.groupBy("path").agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in _ROW[2:]])
    return nodes.select(
        _node(F.col("path")).alias("node"), (_node(_stripped()) if depth else F.lit(None).cast("binary")).alias("parent"),
        F.lit(depth).alias("depth"), "conv", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * last).alias("saved"), "path")


def _peeled(group: list[dict], low: int) -> list[tuple]:
    """The nodes of a subtree down to depth ``low``, from rows with the same path there."""
    due: dict[int, list] = {}
    for r in group:
        digest = hashlib.sha256(r["path"][:low * TOKEN - TOKEN].encode())
        steps = [digest.digest()]  # of the paths of depth low - 1, low, ...
        depth = len(r["path"]) // TOKEN
        for d in range(low, depth + 1):
            digest.update(r["path"][(d - 1) * TOKEN:d * TOKEN].encode())
            steps.append(digest.digest())
        due.setdefault(depth, []).append([r["conv"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], steps, r["path"]])
    out, level = [], {}
    for d in range(max(due), low - 1, -1):
        for row in due.get(d, ()):
            _merge(level, row[5][d - low + 1], row)
        above: dict[bytes, list] = {}
        for node, (conv, n, children, leaves, saved, steps, path) in level.items():
            leaves = leaves if children else 1
            saved += (n - 1) * int(path[d * TOKEN - _BYTES:d * TOKEN], 16)
            out.append((node, steps[d - low], d, conv, n, children, leaves, saved, path[:d * TOKEN] if d == low else None))
            _merge(above, steps[d - low], [conv, n, 1, leaves, saved, steps, path])
        level = above
    return out


def _merge(level: dict, node: bytes, row: list) -> None:
    have = level.get(node)
    if have is None:
        level[node] = row.copy()
        return
    have[0] = min(have[0], row[0])
    for i in range(1, 5):
        have[i] += row[i]


def _band_nodes(rows: DataFrame, low: int, high: int, group_bytes: int) -> DataFrame:
    """The nodes of the depths ``low`` to ``high``; see the module."""
    rows = rows.withColumn("subtree", _node(F.left("path", F.lit(low * TOKEN))))
    large = written(rows.groupBy("subtree").agg(F.sum(F.length("path")).alias("size"))
                    .where(F.col("size") > group_bytes).select("subtree"), "large")
    parts = []
    if not large.isEmpty():
        rows = written(rows.join(large.withColumn("large", F.lit(True)), "subtree", "left"), "band")
        level, here = None, rows.where("large").withColumn("depth", F.expr(f"length(path) div {TOKEN}"))
        for depth in range(high, low - 1, -1):
            own = here.where(F.col("depth") == depth).select(*_ROW)
            level = written(_regrouped(own if level is None else own.union(_parents(level)), depth), "depth")
            parts.append(level.withColumn("path", F.when(F.lit(depth == low), F.col("path"))))
        rows = rows.where("large IS NULL").drop("large")
    kind = rows.schema["conv"].dataType.simpleString()
    schema = (f"node binary, parent binary, depth int, conv {kind}, n_convs long, n_children long, n_leaves long, "
              "saved long, path string")

    def peel(batches):
        group, at = [], None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["subtree"] != at and group:
                    out += _peeled(group, low)
                    group = []
                at = r["subtree"]
                group.append(r)
            if out:
                yield _batch(out, b.schema.field("conv").type)
            conv_type = b.schema.field("conv").type
        if group:
            yield _batch(_peeled(group, low), conv_type)

    parts.append(rows.select("subtree", *_ROW).repartition("subtree").sortWithinPartitions("subtree").mapInArrow(peel, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _batch(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    types = [pa.binary(), pa.binary(), pa.int32(), conv, *[pa.int64()] * 4, pa.string()]
    names = ["node", "parent", "depth", *_ROW[1:], "path"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _parents(nodes: DataFrame) -> DataFrame:
    """The surviving nodes, stripped of their last turn."""
    return nodes.select(_stripped().alias("path"), "conv", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")


def _ends(convs: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): SHA-256 of the identifiers, ascending, comma-joined."""
    kind = convs.schema["conv"].dataType.simpleString()
    named = convs.select("node", "conv", F.col("conv").cast("string").alias("name"))

    def join(batches):
        for b in batches:
            nodes, convs_, names = (b.column(i) for i in range(3))
            nodes, names = nodes.to_pylist(), names.to_pylist()
            starts = [i for i in range(len(nodes)) if not i or nodes[i] != nodes[i - 1]]
            cuts = [c for i, j in zip(starts, [*starts[1:], len(nodes)]) for c in range(i, j, CHUNK)]
            texts = [",".join(names[i:j]) for i, j in zip(cuts, [*cuts[1:], len(nodes)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in cuts], pa.binary()), convs_.take(pa.array(cuts, pa.int64())), pa.array(texts, pa.string())],
                ["node", "conv", "names"])

    def digest(batches):
        at, running = None, None
        for b in batches:
            out = []
            for node, names in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if node != at:
                    if running is not None:
                        out.append((at, running.hexdigest()))
                    at, running = node, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(names.encode())
            yield _pairs(out)
        if running is not None:
            yield _pairs([(at, running.hexdigest())])

    joined = named.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(
        join, f"node binary, conv {kind}, names string")
    return joined.repartition("node").sortWithinPartitions("node", "conv").mapInArrow(digest, "node binary, ends_sha256 string")


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                      ["node", "ends_sha256"])


def prefix_trie(paths: DataFrame, conv: str = "conv_id", tokens: str = "tokens", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The trie of (conv, tokens) as :func:`turn_tokens` gives them, one row per node:
    node and parent (digests of the paths; the root has no parent), conv (the smallest
    conversation that starts with the path), depth, parent_<conv>, n_convs, n_children,
    n_leaves (childless nodes of the subtree, itself included), saved_tokens (over the
    subtree, (n_convs - 1) times the bytes of a node's last text) and ends_sha256 (of
    the conversations that end here, ascending, comma-joined; none: of the empty string).

    A conversation without turns is a member of the root. Null conversations are
    left out. Without conversations there are no nodes.
    """
    spark = paths.sparkSession
    rows = paths.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.array_join(F.coalesce(F.col(tokens), F.array().cast("array<string>")), "").alias("path"))
    rows = written(rows, "paths")
    depth = F.expr(f"length(path) div {TOKEN}")
    folder = shared_path(spark, "ended")
    copies = rows.groupBy("path").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
    copies.withColumn("band", _band(depth)).write.partitionBy("band").option("compression", "zstd").parquet(folder)
    kind = rows.schema["conv"].dataType.simpleString()
    ended = spark.read.schema(f"path string, conv {kind}, n_convs long, band int").parquet(folder)
    top = ended.agg(F.max("band")).first()[0]
    zero = F.lit(0).cast("long")
    level, levels = None, []
    for band in range(top if top is not None else -1, -1, -1):
        low, high = _limits(band)
        due = ended.where(F.col("band") == band).select(
            "path", "conv", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"))
        if level is not None:
            due = due.union(_parents(level.where("path IS NOT NULL")))
        level = written(_regrouped(due, low) if low == high else _band_nodes(due, low, high, group_bytes), f"level-{band}")
        levels.append(level)
    nodes = spark.createDataFrame([], _regrouped(rows.select(
        "path", "conv", *[zero.alias(c) for c in _ROW[2:]]), 0).schema) if not levels else levels[0]
    for part in levels[1:]:
        nodes = nodes.unionByName(part)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    ends = _ends(rows.select(_node(F.col("path")).alias("node"), "conv"))
    return (nodes.drop("path").join(parents, "parent", "left").join(ends, "node", "left").select(
        "node", "parent", F.col("conv").alias(conv), F.col("depth").cast("long").alias("depth"),
        F.col("parent_conv").alias(f"parent_{conv}"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
