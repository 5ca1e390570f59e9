"""Validation, routing and rejection accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.rules import default_rules, raw_anomaly
from fleetscope.schema import DEAD_LETTER_DEFAULT_ID, REASON_SEP
from fleetscope.sources.messages import decode_fields

CLEAN_COLUMNS = ("event_id", "timestamp", "device_id", "metric_name", "value",
                 "unit", "location")


def validate(decoded: DataFrame,
             rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """V1-V5: add ``rejection_reason`` (null when the row passes every rule).

    Every applicable reason is kept, joined by "; " in rule order, and as an
    array ``reasons`` with an item for each rule (null: passed). One projection,
    no shuffle, no UDF; the array is pruned where nothing reads it.
    """
    outcomes = [c for _, c in (rules if rules is not None else default_rules())]
    return decoded.select(
        "*", F.array(*outcomes).alias("reasons"),
        F.nullif(F.concat_ws(REASON_SEP, *outcomes), F.lit("")).alias("rejection_reason"))


def is_valid() -> Column:
    return F.col("rejection_reason").isNull()


def dead_letter_id(c: Column) -> Column:
    """V7: null or empty id becomes "unknown"."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(DEAD_LETTER_DEFAULT_ID))


def clean_side(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """V6, valid half: the clean-events projection."""
    return validated.where(is_valid()).select(*keep, *CLEAN_COLUMNS)


def dead_side(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """V6, invalid half: id (V7), the raw text and the reasons."""
    return validated.where(~is_valid()).select(
        *keep,
        dead_letter_id(F.col("event_id")).alias("event_id"),
        F.col("raw_value").alias("original_data"),
        "rejection_reason",
    )


def route_labels(validated: DataFrame) -> DataFrame:
    """V6 as one frame: every input row with its side and reasons."""
    return validated.select(
        F.when(is_valid(), F.col("event_id"))
         .otherwise(dead_letter_id(F.col("event_id"))).alias("event_id"),
        F.when(is_valid(), F.lit("clean")).otherwise(F.lit("dead_letter")).alias("route"),
        "rejection_reason",
    )


def rejection_summary(validated: DataFrame) -> DataFrame:
    """Rows per rule outcome (a row with two reasons counts twice).

    Counts the array of reasons, not the joined text: a value that holds the
    separator cannot make up reasons. The offending value is dropped (all that
    follows the first colon), so there is one row per outcome and a partial
    aggregate absorbs a dominant one.
    """
    return (validated.where(~is_valid()).select(F.explode("reasons").alias("reason"))
            .where("reason IS NOT NULL")
            .select(F.regexp_replace("reason", r"(?s):.*$", "").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("event_count")))


def raw_anomaly_flags(messages: DataFrame) -> DataFrame:
    """V9: flag each raw message by the consumer-side heuristic (on the raw
    timestamp text, before any parsing).

    The text is parsed once, with the value kept as a variant: a value that was sent as
    text (or as anything but a number) is not missing, and the heuristic compares
    numbers only, so it passes; an absent or null value does not."""
    d = decode_fields(messages, keep=("offset",), value="variant")
    kind = F.schema_of_variant("value")
    number = F.coalesce(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), F.lit(False))
    value = (F.when(number, F.try_variant_get("value", "$", "double"))
             .when(kind.isNotNull() & (kind != "VOID"), F.lit(0.0)))
    return d.select(
        "offset", "event_id",
        raw_anomaly(value, F.col("metric_name"), F.col("timestamp")).alias("is_anomaly"),
    )


def raw_anomaly_summary(flags: DataFrame) -> DataFrame:
    """Totals and the anomaly percentage with a floor of 1 on the total."""
    total = F.count(F.lit(1))
    anomalies = F.count_if(F.col("is_anomaly"))
    return flags.agg(total.alias("total"), anomalies.alias("anomalies")).select(
        "total", "anomalies",
        F.round(F.col("anomalies") * 100.0 / F.greatest(F.col("total"), F.lit(1)), 1)
         .alias("anomaly_pct"),
    )


def registry_flag(df: DataFrame, registry: DataFrame, col: str,
                  flag: str = "_known") -> DataFrame:
    """V2 for registries too large to inline as an ``IN`` list.

    A left equi-join against the distinct ids adds ``flag`` (true when known,
    null otherwise; feed it to ``device_rule(known=...)``). Spark broadcasts the
    registry when its measured size allows, and else splits hot ids of the
    shuffle join. Null ids never match.
    """
    reg = (registry.select(F.col(registry.columns[0]).alias("_rid")).distinct()
           .withColumn(flag, F.lit(True)))
    return df.join(reg, df[col] == reg["_rid"], "left").drop("_rid")
