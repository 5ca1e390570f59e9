"""Shared derivations from the given tables, used by every registered query.

Each function is lazy: it returns a DataFrame plan, nothing is computed here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import validate as V
from fleetscope.session import prepare
from fleetscope.sources.fixtures import telemetry_messages
from fleetscope.sources.messages import decode


def ntz(c: str | Column) -> Column:
    """Publish an instant as a zone-less timestamp (UTC wall clock)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return telemetry_messages(spark, sf_dir)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(messages(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.validate(decoded(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str, keep=("snapshot_id",)) -> DataFrame:
    return V.clean_side(validated(spark, sf_dir), keep=keep)


def dead(spark: SparkSession, sf_dir: str, keep=("snapshot_id",)) -> DataFrame:
    return V.dead_side(validated(spark, sf_dir), keep=keep)
