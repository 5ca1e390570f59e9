"""Feature preparation on the clean events, entirely in DataFrames.

Per-column statistics (means for imputation, min/max for scaling, the row
count for the split) follow the estimator pattern: ``fit`` runs one
distributed aggregate whose single row -- a handful of numbers, bounded by
the feature count -- comes back to the driver, and ``transform`` is a lazy
projection with those numbers as literals. No join, no cross product, and
plans stay flat however many stages are chained.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.ranking import sorted_rank
from fleetscope.schema import METRICS, TRAIN_RATIO, VAL_RATIO

FEATURE_INPUT = ("timestamp", "device_id", "metric_name", "value")


def load_events(clean: DataFrame, snapshot_id: int | None = None) -> DataFrame:
    """F1 + S4: four columns, optionally as of a snapshot (falsy = latest).

    Where ``snapshot_id`` is the table's partition column (the versioned
    store), the predicate prunes whole snapshot directories at the scan.
    """
    df = clean
    if snapshot_id:
        df = df.where(F.col("snapshot_id") <= F.lit(int(snapshot_id)))
    return df.select(*FEATURE_INPUT)


def time_window(ts: Column, grain: str = "1 minute") -> Column:
    """floor to the grain (epoch-aligned)."""
    if grain in ("1 minute", "minute"):
        return F.date_trunc("minute", ts)
    if grain in ("1 hour", "hour"):
        return F.date_trunc("hour", ts)
    return F.window(ts, grain).start


def pivot_metrics(events: DataFrame, grain: str = "1 minute",
                  keys: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    """one row per window (x keys), one mean column per metric.

    Written as a conditional aggregate (``avg(value) FILTER metric = m`` per
    metric) rather than ``groupBy().pivot()``: same result, but one shuffle
    on the window instead of pivot's two (an aggregate on (window, metric),
    then a second one for the pivot). The metric list is fixed, so no job
    discovers it and the output columns are stable. Groups are bounded by the
    number of windows; partial aggregation absorbs a dominant device or
    metric map-side. NaN values are skipped like nulls; a window without any
    value is no row.
    """
    metric = F.col("metric_name")
    value = F.when(~F.isnan("value"), F.col("value"))
    return (events.where(F.col("timestamp").isNotNull())
            .withColumn("time_window", time_window(F.col("timestamp"), grain))
            .groupBy("time_window", *keys)
            .agg(*[F.avg(F.when(metric == m, value)).alias(m) for m in metrics])
            .dropna("all", subset=list(metrics)))


def pivot_stats(pivoted: DataFrame, metrics: Sequence[str] = METRICS) -> dict:
    """One aggregate over the pivot giving every fit of the default path.

    Filling a column's gaps with its own mean leaves its min and max
    unchanged and leaves no row incomplete, so the imputation means, the
    scaler's min/max (a metric never seen is all 0.0) and the vector count
    all come from this single job.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        aggs += [F.avg(m).alias(f"avg_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    r = pivoted.agg(*aggs).first()
    return {
        "n": int(r["n"]),
        "means": {m: r[f"avg_{m}"] for m in metrics},
        "scaler": {m: ((0.0, 0.0) if r[f"min_{m}"] is None else (r[f"min_{m}"], r[f"max_{m}"]))
                   for m in metrics},
    }


def impute(pivoted: DataFrame, metrics: Sequence[str] = METRICS,
           means: dict | None = None) -> DataFrame:
    """F4 + F5: fill a missing cell with its column mean over the pivoted rows
    (0.0 when the metric never occurs), then drop rows still incomplete."""
    if means is None:
        row = pivoted.agg(*[F.avg(m).alias(m) for m in metrics]).first()
        means = {m: row[m] for m in metrics}
    cols = [F.coalesce(F.col(m), F.lit(means[m]).cast("double"), F.lit(0.0)).alias(m)
            for m in metrics]
    keep = [c for c in pivoted.columns if c not in metrics]
    return pivoted.select(*keep, *cols).dropna(subset=list(metrics))


def fit_scaler(features: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """F7 (fit) + F10: one row per feature with the data min and max."""
    mins = [F.min(m) for m in metrics]
    maxs = [F.max(m) for m in metrics]
    agg = features.agg(*[x.alias(f"min_{m}") for x, m in zip(mins, metrics)],
                       *[x.alias(f"max_{m}") for x, m in zip(maxs, metrics)])
    rows = F.array(*[F.struct(F.lit(i).alias("feature_index"), F.lit(m).alias("feature_name"),
                              F.col(f"min_{m}").alias("data_min"),
                              F.col(f"max_{m}").alias("data_max"))
                     for i, m in enumerate(metrics)])
    return agg.select(F.inline(rows))


def scaler_values(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted parameters (one row per feature) as ``{name: (min, max)}``."""
    return {r["feature_name"]: (r["data_min"], r["data_max"])
            for r in scaler.select("feature_name", "data_min", "data_max").collect()}


def scale(x: Column, lo: Column, hi: Column) -> Column:
    """Min-max to [0, 1]; a constant column maps to 0 (range treated as 1)."""
    rng = hi - lo
    return F.when(rng == 0, x - lo).otherwise((x - lo) / rng)


def apply_scaler(features: DataFrame, scaler: DataFrame | None = None,
                 metrics: Sequence[str] = METRICS,
                 params: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """F7 (transform) / F8: scale with given parameters; no clipping."""
    params = params if params is not None else scaler_values(scaler)
    cols = [scale(F.col(m), F.lit(params[m][0]), F.lit(params[m][1])).alias(m)
            for m in metrics]
    keep = [c for c in features.columns if c not in metrics]
    return features.select(*keep, *cols)


def split_bounds(n: int, train_ratio: float = TRAIN_RATIO,
                 val_ratio: float = VAL_RATIO) -> tuple[int, int]:
    """Python ``int()`` of double products, as positional slicing does."""
    return int(n * float(train_ratio)), int(n * float(train_ratio + val_ratio))


def chronological_split(features: DataFrame, keys: Sequence[str] = (),
                        train_ratio: float = TRAIN_RATIO,
                        val_ratio: float = VAL_RATIO, n: int | None = None) -> DataFrame:
    """positional split by time -- first int(n*0.7) train, up to
    int(n*(0.7+0.15)) validation, the rest test (truncation in doubles).

    Positions come from a range-partitioned sort on (window, keys): a window
    with a third of all vectors is spread over as many tasks as any other third.
    """
    n = features.count() if n is None else n
    ranked = sorted_rank(features, ["time_window", *keys], rank_col="position")
    t_end, v_end = split_bounds(n, train_ratio, val_ratio)
    split = (F.when(F.col("position") < t_end, F.lit("train"))
             .when(F.col("position") < v_end, F.lit("val"))
             .otherwise(F.lit("test")))
    return ranked.withColumn("split", split)


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
