"""Connected components of an edge table by alternating star contraction.

Each round attaches every larger neighbour of a node to the smallest node in
its neighbourhood, then every smaller one; the edges turn into stars in a
number of rounds that grows with the logarithm of the graph. A round is two
shuffles of the edges, with the neighbourhood minima pre-aggregated; a node
that holds a third of the edges meets them in a join whose other side has one
row for it, which adaptive execution splits. No neighbourhood is ever gathered.
Each round is written to the shared folder, so a lost executor costs no more
than its own tasks, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``, two bigint columns: root is the
    smallest node that can be reached. Loops and repeated edges are harmless,
    edges with a null are ignored; no edges give no rows."""
    a, b = edges.columns
    e = written(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                .where("a != b").distinct(), "edges")

    def mark(x: DataFrame):
        return x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(e)
    while seen[0]:
        e = written(_small_star(_large_star(e).where("a != b").distinct()).where("a != b").distinct(),
                    "edges")
        now = mark(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
            .union(e.select(F.least("a", "b"), F.least("a", "b"))).distinct())
