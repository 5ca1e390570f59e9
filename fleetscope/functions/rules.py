"""Validation rules as Column expressions.

A rule maps the decoded columns to a reason text, or null when the row passes.
Rules are plain ``(name, Column)`` pairs, so callers can add their own; order
is part of the contract because the reasons are joined in rule order.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope.functions.numeric import python_float_text

from fleetscope.schema import (
    DEVICE_IDS, FUTURE_YEAR, METRICS, MISSING_TEXT, RAW_EXTREME_ABOVE, RAW_FUTURE_PREFIX,
    RAW_UNKNOWN_METRIC_PREFIX, REASON_NEGATIVE_VALUE, REASON_TIMESTAMP_FUTURE,
    REASON_TIMESTAMP_NULL, REASON_UNKNOWN_DEVICE, REASON_UNKNOWN_METRIC, REASON_VALUE_NULL,
)


def _show(c: Column) -> Column:
    """Text of a possibly-null string the way the event's printer shows it."""
    return F.coalesce(c, F.lit(MISSING_TEXT))


def not_member(c: Column, allowed: Iterable[str]) -> Column:
    """True when ``c`` is null or not in ``allowed``.

    ``NULL IN (...)`` is NULL, hence the coalesce. Small registries become an
    ``InSet`` hash lookup; use :func:`fleetscope.operators.validate.registry_flag`
    for registries too large to inline.
    """
    return ~F.coalesce(c.isin(list(allowed)), F.lit(False))


def timestamp_rule(ts: Column) -> Column:
    return (F.when(ts.isNull(), F.lit(REASON_TIMESTAMP_NULL))
            .when(F.year(ts) >= FUTURE_YEAR, F.lit(REASON_TIMESTAMP_FUTURE)))


def device_rule(device: Column, registry: Sequence[str] = DEVICE_IDS,
                known: Column | None = None) -> Column:
    unknown = not_member(device, registry) if known is None else ~F.coalesce(known, F.lit(False))
    return F.when(unknown, F.concat(F.lit(REASON_UNKNOWN_DEVICE), _show(device)))


def value_rule(value: Column) -> Column:
    return (F.when(value.isNull(), F.lit(REASON_VALUE_NULL))
            .when(value < 0, F.concat(F.lit(REASON_NEGATIVE_VALUE), python_float_text(value))))


def metric_rule(metric: Column, allowed: Sequence[str] = METRICS) -> Column:
    return F.when(not_member(metric, allowed),
                  F.concat(F.lit(REASON_UNKNOWN_METRIC), _show(metric)))


def default_rules() -> list[tuple[str, Column]]:
    """The four rules in contract order: timestamp, device, value, metric."""
    return [
        ("timestamp", timestamp_rule(F.col("timestamp"))),
        ("device", device_rule(F.col("device_id"))),
        ("value", value_rule(F.col("value"))),
        ("metric", metric_rule(F.col("metric_name"))),
    ]


def raw_anomaly(value: Column, metric: Column, timestamp_text: Column) -> Column:
    """V9: the raw-stream heuristic (a different rule set from validation).

    NaN is neither above nor below a bound here (Spark otherwise orders NaN
    above every number).
    """
    extreme = (value > RAW_EXTREME_ABOVE) & ~F.isnan(value)
    return (value.isNull() | extreme | (value < 0)
            | F.coalesce(metric.startswith(RAW_UNKNOWN_METRIC_PREFIX), F.lit(False))
            | F.coalesce(timestamp_text.startswith(RAW_FUTURE_PREFIX), F.lit(False)))
