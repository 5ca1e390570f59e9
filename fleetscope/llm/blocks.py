"""Comparing all members of a key's group without gathering the group.

A group of up to ``size`` members is one block and is compared in one place. A
larger group is dealt into blocks by a hash, and each pair of its blocks is a
unit of its own, so that a group with a third of all rows spreads over the
cluster and no task holds more than two blocks. A unit returns sums for each
member and one star for each set of connected members, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = ["__key", "__lo", "__hi"]


def units(members: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """``members`` of groups with at least two rows, one row for each unit they
    belong to: adds __key, __lo, __hi (the blocks of the unit), __block (the
    member's) and __n (blocks of the group). ``member`` tells members apart."""
    counts = members.groupBy(*keys).agg(F.count("*").alias("__c")).where("__c > 1")
    n = F.ceil(F.col("__c") / size).cast("int")
    dealt = (members.join(counts, keys).withColumn("__n", n)
             .withColumn("__block", F.pmod(F.xxhash64(F.lit("block"), F.col(member)),
                                           F.col("__n").cast("long")).cast("int")))
    others = F.when(F.col("__n") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("__n") - 1), F.array("__block")))
    paired = dealt.withColumn("__other", F.explode(others))
    return paired.select(
        F.struct(*keys).alias("__key"), F.least("__block", "__other").alias("__lo"),
        F.greatest("__block", "__other").alias("__hi"), "__block", "__n",
        *[c for c in members.columns if c not in keys]).repartition(*UNIT).sortWithinPartitions(*UNIT)


def by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The units of a partition that is sorted by unit. One unit is at most two
    blocks, so what is carried from batch to batch is bounded."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0)
        if isinstance(key, pa.StructArray):
            parts = [key.field(i) for i in range(key.type.num_fields)]
        else:
            parts = [key]
        cols = [np.asarray(c.to_numpy(zero_copy_only=False)) for c in (*parts, batch.column(1), batch.column(2))]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:]):
            held.append(batch.slice(i, j - i))
            if j < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """For each component of a symmetric boolean matrix, one member joined to all others."""
    left = linked.any(axis=1)
    out = []
    while left.any():
        start = int(np.argmax(left))
        left[start] = False
        front = np.array([start])
        while len(front):
            new = np.flatnonzero(linked[front].any(axis=0) & left)
            left[new] = False
            out += [(start, int(i)) for i in new]
            front = new
    return out


def compared(members: DataFrame, keys: list[str], member: str, size: int, schema: str,
             unit: Callable[[pa.Table], pa.RecordBatch | None]) -> DataFrame:
    """Run ``unit`` on every unit of every group; one result table."""
    def run(batches):
        for table in by_unit(batches):
            result = unit(table)
            if result is not None and result.num_rows:
                yield result
    return units(members, keys, member, size).mapInArrow(run, schema)
