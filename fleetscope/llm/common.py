"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character is kept as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the checkpoint folder that all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    The files survive the loss of any executor. They stay in the checkpoint
    folder until its owner clears it, like the files of ``checkpoint()``.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STATE: tuple[Hashable, Any] | None = None


def worker_state(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under ``key``, made if it has it not. Spark hands
    a worker on from one operator to the next: it keeps one thing, and what it kept before goes
    before the new one is made."""
    global _STATE
    if _STATE is None or _STATE[0] != key:
        _STATE = None
        _STATE = key, make()
    return _STATE[1]
