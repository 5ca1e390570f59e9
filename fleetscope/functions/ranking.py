"""Global positions and exact quantiles without a single-task window."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.session import checkpoint_dir, written

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row in partition


def sorted_rank(df: DataFrame, order: Sequence[str | Column],
                rank_col: str = "_rank") -> DataFrame:
    """0-based global position in the order of the sort keys, at any size.

    A range-partitioned sort spreads the rows over tasks. Rows of equal keys are ordered by a hash of
    all their columns, so a retried task or a second run gives every row the same position; a
    random last key lets the sort split a run of entirely equal rows, whose
    positions are interchangeable. A row's place inside its range
    partition comes from ``monotonically_increasing_id``. The sorted frame is
    checkpointed (reliable storage, ``spark.checkpoint.dir``), so positions and
    partition counts come from one materialisation even if executors are lost.
    The driver adds up one count per partition; the offsets it sends back are
    as many numbers as there are shuffle partitions.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    s = (df.withColumn("_row", F.xxhash64(*[F.col(c) for c in df.columns])).withColumn("_tie", F.rand(seed=17))
         .orderBy(*order, "_row", "_tie").drop("_row", "_tie")
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    s = (s.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS).cast("long"))
          .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    run, offsets = 0, []
    for part, n in sorted(map(tuple, s.groupBy("_part").count().collect())):
        offsets.append((part, run))
        run += n
    table = spark.createDataFrame(offsets, "_part long, _offset long")
    return (s.join(F.broadcast(table), "_part")
            .withColumn(rank_col, F.col("_offset") + F.col("_local"))
            .drop("_mid", "_part", "_local", "_offset"))


#: Distinct values that are fetched to read a quantile off.
BRACKET = 10_000
#: Accuracy of the sketches that narrow the bracket.
SKETCH = 10_000


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default method).

    For n values sorted ascending, q(p) = v[lo] + (v[hi] - v[lo]) * frac with
    pos = p * (n - 1), lo = floor(pos), hi = ceil(pos). Mergeable sketches give
    a bracket around each position; exact counts of what lies below and inside
    prove it, and a further sketch of the bracket narrows it, until few values
    are left. These come back with their counts and the positions are read
    off. Every pass is one aggregate, and no buffer holds the input. The values alone are written to
    the shared folder first, so the passes do not run ``df`` again. One row,
    a column for each probability; nulls are skipped; no values give nulls.
    """
    spark = df.sparkSession
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    vals = written(df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull()), "quantiles")
    v = F.col("_v")
    n = vals.count()
    if n == 0:
        return spark.range(1).select(*[F.lit(None).cast("double").alias(x) for x in names])
    low, high = -math.inf, math.inf
    ranks = [(math.floor(p * (n - 1)), math.ceil(p * (n - 1))) for p in probs]
    brackets = [(low, high, 0, n)] * len(probs)  # from, to, rows below, rows inside

    def inside(b):
        # NaN sorts above every number, and so above any bracket that is not open
        return (v >= b[0]) & ((v <= b[1]) | F.lit(b[1] == high))

    while True:
        wide = [i for i, b in enumerate(brackets) if b[3] > BRACKET and b[0] < b[1]]
        if not wide:
            break
        sketches = vals.agg(*[F.percentile_approx(
            F.when(inside(brackets[i]), v),
            [min(1.0, max(0.0, (r - brackets[i][2]) / brackets[i][3] + e))
             for r, e in zip(ranks[i], (-2 / SKETCH, 2 / SKETCH))], SKETCH).alias(f"b{i}") for i in wide]).first()
        tried = {i: (sketches[f"b{i}"][0], sketches[f"b{i}"][1]) for i in wide}
        counts = vals.agg(*[x for i, (a, b) in tried.items() for x in (
            F.count_if(v < a).alias(f"below{i}"), F.count_if((v >= a) & (v <= b)).alias(f"in{i}"))]).first()
        moved = False
        for i, (a, b) in tried.items():
            below, held = counts[f"below{i}"], counts[f"in{i}"]
            if below <= ranks[i][0] and ranks[i][1] < below + held and held < brackets[i][3]:
                brackets[i], moved = (a, b, below, held), True
        if not moved:  # what is left are a few values with many rows each
            break
    some = functools.reduce(lambda x, y: x | y, map(inside, brackets))
    found = sorted(map(tuple, vals.where(some).groupBy("_v").count().collect()),
                   key=lambda x: (x[0] != x[0], x[0]))
    out = []
    for p, (lo, hi), b in zip(probs, ranks, brackets):
        at, picked = b[2], {}
        for value, rows in found:
            if value < b[0] or (value > b[1]):
                continue
            for r in (lo, hi):
                if at <= r < at + rows:
                    picked[r] = value
            at += rows
        frac = p * (n - 1) - lo
        out.append(picked[lo] + (picked[hi] - picked[lo]) * frac if frac else picked[lo])
    return spark.range(1).select(*[F.lit(float(q)).alias(x) for q, x in zip(out, names)])


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                     names: Sequence[str] | None = None, accuracy: int = 100000) -> DataFrame:
    """Mergeable-sketch quantiles for when exactness is not required."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    arr = F.percentile_approx(col, [float(p) for p in probs], accuracy)
    return df.agg(arr.alias("_q")).select(
        *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
