"""M7 over ranges of snapshots: quantile sketches that are kept and merged.

A KLL sketch of a few kilobytes stands for the values of a snapshot (or day). Kept as a row, the
sketches of any range merge into that of the range, without reading the values again. A quantile
read off has a rank error of at most ``RANK_ERROR`` with 99 % confidence at the default size.
Exact thresholds (fleetscope.functions.ranking) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches, and the rank error that it bounds.
K, RANK_ERROR = 2048, 0.0025


def kept_sketches(df: DataFrame, by: Sequence[Column | str], value: str = "error", k: int = K) -> DataFrame:
    """(``by``, n, sketch): one row for each snapshot; null values are left out."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], names: Sequence[str], by: Sequence[Column | str] = ()) -> DataFrame:
    """The quantiles of the rows' values together: ``n`` and a column for each name, null without values."""
    whole = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_s"))
    kept = [c for c in whole.columns if c != "_s"]
    read = lambda p: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_s", F.lit(float(p))))
    return whole.select(*kept, *[read(p).alias(name) for p, name in zip(probs, names)])


def rank_spans(df: DataFrame, value: str, at: dict[str, float]) -> DataFrame:
    """For each named number: the share of values below it and up to it, counted exactly, in one row."""
    v = F.col(value).cast("double")
    n = F.count(v)
    return df.agg(n.alias("n"), *[x for name, q in at.items() for x in (
        (F.count_if(v < F.lit(q)) / n).alias(f"{name}_below"), (F.count_if(v <= F.lit(q)) / n).alias(f"{name}_upto"))])
