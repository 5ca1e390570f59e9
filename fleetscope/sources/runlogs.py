"""S5 + S8: experiment run logs and evaluation reports as JSON.

Two layouts are read: the trainer's own (``<root>/exp_*/experiment.json`` and
``evaluation.json``, one pretty-printed document per file) and the table
layout written here (``<root>/run_logs`` / ``<root>/evaluations``, JSON lines
partitioned by ``experiment_id``). The experiment id always comes from the
data or the file path, never from a driver-side listing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.schema import EVALUATION, RUN_LOG
from fleetscope.sources import store

_ID_FROM_PATH = r".*/(exp_[^/]+)/[^/]+$"


def _read_documents(spark: SparkSession, root: str, file_name: str, schema) -> DataFrame:
    if not store.matches(spark, os.path.join(root, "exp_*", file_name)):
        return spark.createDataFrame([], schema)
    df = (spark.read.schema(schema).option("multiLine", True)
          .json(os.path.join(root, "exp_*", file_name)))
    path_id = F.regexp_extract(F.col("_metadata.file_path"), _ID_FROM_PATH, 1)
    return df.withColumn("experiment_id",
                         F.coalesce(F.nullif(path_id, F.lit("")), F.col("experiment_id")))


def read_run_logs(spark: SparkSession, root: str) -> DataFrame:
    """Run logs; directories without ``experiment.json`` simply contribute none."""
    return _read_documents(spark, root, "experiment.json", RUN_LOG)


def read_evaluations(spark: SparkSession, root: str) -> DataFrame:
    """Evaluation reports; optional per run."""
    return _read_documents(spark, root, "evaluation.json", EVALUATION)


def write_reports(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Reports as JSON lines, one directory per experiment (dynamic
    partition overwrite: rewriting one run leaves the others alone)."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy("experiment_id").json(path))


def read_reports(spark: SparkSession, path: str, schema) -> DataFrame:
    fields = [f for f in schema.fields if f.name != "experiment_id"]
    from pyspark.sql.types import StringType, StructField, StructType
    sch = StructType(fields + [StructField("experiment_id", StringType())])
    if not store.matches(spark, path):
        return spark.createDataFrame([], sch)
    return spark.read.schema(sch).json(path)
