"""A1-A5: hourly statistics per device and metric."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import exact

AGG_KEYS = ("hour_window", "device_id", "metric_name")
SAMPLE_COLUMNS = ("hour_window", "device_id", "metric_name", "avg_value",
                  "min_value", "max_value", "event_count")


def hourly_states(clean: DataFrame, width: str = "1 hour",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Mergeable statistics: exact sums per window x device x metric (and exponent bin).

    Map-side combining collapses a hot device to one partial row per (task,
    hour, metric, bin) before anything is shuffled. Null timestamps fall out of
    ``window``. ``keep`` adds extra grouping columns.
    """
    if width in ("1 hour", "hour"):
        # Same epoch-aligned UTC buckets as window(), but a flat timestamp key
        # hashes cheaper than the window struct.
        src = clean.where(F.col("timestamp").isNotNull())
        key = F.date_trunc("hour", F.col("timestamp"))
    else:
        src = clean.where(F.col("timestamp").isNotNull())
        key = F.window("timestamp", width).start
    src = src.select(key.alias("hour_window"), "device_id", "metric_name", *keep, "value")
    return exact.states(src, [*AGG_KEYS, *keep])


def merged_states(parts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The states of several runs as those of one run over all their rows, in any order."""
    return exact.merged(parts, [*AGG_KEYS, *keep])


def hourly_from_states(states: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A2 over states: avg/min/max/sample stddev rounded to 2 decimals plus ``count(*)``."""
    return exact.statistics(states, [*AGG_KEYS, *keep]).selectExpr(
        *AGG_KEYS, "round(mean, 2) AS avg_value", "round(low, 2) AS min_value", "round(high, 2) AS max_value",
        "round(deviation, 2) AS stddev_value", "n_rows AS event_count", *keep)


def hourly_aggregates(clean: DataFrame, width: str = "1 hour",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """A1-A3: tumbling, epoch-aligned windows x device x metric.

    The sums are exact (see :mod:`fleetscope.functions.exact`), so mean, deviation and
    their rounding do not depend on partitions or on the order of rows. Two
    exchanges, both of aggregated rows: on the key and its bin, then on the key.
    """
    return hourly_from_states(hourly_states(clean, width, keep), keep)


def hourly_sample(aggregates: DataFrame, n: int = 10) -> DataFrame:
    """A5: a reproducible first-n sample (top-k by key, not an arbitrary limit)."""
    return (aggregates.select(*SAMPLE_COLUMNS)
            .orderBy(*AGG_KEYS).limit(n))
