"""Q1-Q6: data-quality checks and the pass/fail gate.

Each check yields rows of ``(check, passed, detail)``. The full report reads
the table once: a profile per ``event_id``, partial per task, is shuffled by the id
and summed. A single check reads only what it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.schema import (
    DETAIL_DUPLICATES, DETAIL_NO_DATA, DETAIL_NULL_RATE, DETAIL_NULLS_OK, DETAIL_RANGE,
    DETAIL_ROW_COUNT, GATE_FAIL, GATE_PASS, MAX_NULL_RATE, MIN_ROW_COUNT, NULL_CHECK_COLUMNS,
    RANGE_MAX, RANGE_MIN,
)

NO_DATA = DETAIL_NO_DATA


def _check(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                    detail.alias("detail"))


def profile(clean: DataFrame, columns=NULL_CHECK_COLUMNS) -> DataFrame:
    """One-row profile: total, per-column nulls, value range and counts."""
    return clean.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.min("value").alias("min_val"),
        F.max("value").alias("max_val"),
        F.count_if(F.col("value") < RANGE_MIN).alias("negative_count"),
        F.count_if(F.col("value") > RANGE_MAX).alias("extreme_count"),
    )


def id_profile(clean: DataFrame, columns=NULL_CHECK_COLUMNS) -> DataFrame:
    """:func:`profile` plus the exact distinct count of ``event_id``, in one scan.

    The profile is taken per id first (a hot id collapses map-side) and then
    summed: one shuffle on the id serves the distinct count and carries the rest.
    """
    others = [c for c in columns if c != "event_id"]
    by_id = clean.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in others],
        F.min("value").alias("min_val"), F.max("value").alias("max_val"),
        F.count_if(F.col("value") < RANGE_MIN).alias("negative_count"),
        F.count_if(F.col("value") > RANGE_MAX).alias("extreme_count"))
    add = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return by_id.agg(
        add("n").alias("total"), add(F.when(F.col("event_id").isNull(), F.col("n"))).alias("null_event_id"),
        *[add(f"null_{c}").alias(f"null_{c}") for c in others],
        F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        add("negative_count").alias("negative_count"), add("extreme_count").alias("extreme_count"),
        F.count("event_id").alias("unique_ids"))


def id_counts(clean: DataFrame) -> DataFrame:
    """(event_id, n): the rows of every id, null included; a hot id collapses map-side."""
    return clean.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


def duplicates_from_counts(counts: DataFrame) -> DataFrame:
    """Q4 from (event_id, n) rows, each id once: rows and distinct ids (nulls are no id)."""
    p = counts.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total"), F.count("event_id").alias("unique_ids"))
    return _rows(p, [duplicate_check(p)]).drop("check_order")


def row_count_check(p: DataFrame, min_threshold: int = MIN_ROW_COUNT) -> Column:
    return _check("row_count", F.col("total") >= min_threshold,
                  F.format_string(DETAIL_ROW_COUNT.format(threshold=int(min_threshold)),
                                  F.col("total")))


def null_rate_check(p: DataFrame, max_null_rate: float = MAX_NULL_RATE,
                    columns=NULL_CHECK_COLUMNS) -> Column:
    limit_text = f"{max_null_rate:.0%}".replace("%", "%%")
    total = F.col("total")
    failures = F.concat_ws("; ", *[
        F.when(F.col(f"null_{c}") / total > max_null_rate,
               F.format_string(DETAIL_NULL_RATE.format(column=c, limit=limit_text),
                               F.col(f"null_{c}") * 100.0 / total))
        for c in columns])
    empty = total == 0
    passed = ~empty & (failures == "")
    detail = (F.when(empty, F.lit(NO_DATA))
              .when(failures == "", F.lit(DETAIL_NULLS_OK))
              .otherwise(failures))
    return _check("null_rates", passed, detail)


def value_range_check(p: DataFrame) -> Column:
    empty = F.col("total") == 0
    passed = ~empty & (F.col("negative_count") == 0) & (F.col("extreme_count") == 0)
    detail = F.when(empty, F.lit(NO_DATA)).otherwise(F.format_string(
        DETAIL_RANGE.format(limit=int(RANGE_MAX)),
        F.col("min_val"), F.col("max_val"), F.col("negative_count"),
        F.col("extreme_count")))
    return _check("value_ranges", passed, detail)


def duplicate_check(p: DataFrame) -> Column:
    dup = F.col("total") - F.col("unique_ids")
    return _check("duplicates", dup == 0, F.format_string(
        DETAIL_DUPLICATES, F.col("total"), F.col("unique_ids"), dup))


def _rows(p: DataFrame, checks: list[Column]) -> DataFrame:
    ordered = [F.struct(F.lit(i + 1).alias("check_order"), c.alias("r"))
               for i, c in enumerate(checks)]
    return (p.select(F.inline(F.array(*ordered)))
            .select("check_order", "r.check", "r.passed", "r.detail"))


def check_row_count(clean: DataFrame, min_threshold: int = MIN_ROW_COUNT) -> DataFrame:
    p = clean.agg(F.count(F.lit(1)).alias("total"))
    return _rows(p, [row_count_check(p, min_threshold)]).drop("check_order")


def check_null_rates(clean: DataFrame, max_null_rate: float = MAX_NULL_RATE) -> DataFrame:
    p = profile(clean)
    return _rows(p, [null_rate_check(p, max_null_rate)]).drop("check_order")


def check_value_ranges(clean: DataFrame) -> DataFrame:
    p = profile(clean)
    return _rows(p, [value_range_check(p)]).drop("check_order")


def check_duplicates(clean: DataFrame) -> DataFrame:
    """Q4 in one scan and one shuffle of ids, pre-aggregated."""
    return duplicates_from_counts(id_counts(clean))


def quality_report(clean: DataFrame, min_threshold: int = MIN_ROW_COUNT,
                   max_null_rate: float = MAX_NULL_RATE) -> DataFrame:
    """Q5: the four checks in order row_count, null_rates, value_ranges, duplicates."""
    p = id_profile(clean)
    checks = [row_count_check(p, min_threshold), null_rate_check(p, max_null_rate),
              value_range_check(p), duplicate_check(p)]
    return _rows(p, checks)


def gate(report: DataFrame) -> DataFrame:
    """Q6: one verdict row -- aggregate when every check passed, else alert."""
    failed = F.filter(F.sort_array(F.collect_list(F.struct("check_order", "check", "passed"))),
                      lambda x: ~x["passed"])
    return report.agg(
        F.bool_and("passed").alias("all_passed"),
        F.array_join(F.transform(failed, lambda x: x["check"]), ",").alias("failed_checks"),
    ).select(
        "all_passed",
        F.when(F.col("all_passed"), F.lit(GATE_PASS)).otherwise(F.lit(GATE_FAIL)).alias("action"),
        "failed_checks",
    )
