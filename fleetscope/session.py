"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs depend on for correct results (UTC calendar arithmetic)
# and for sane plans (AQE re-plans shuffles from runtime statistics).
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "fleetscope",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_REQUIRED)
    conf.update({
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings the jobs depend on (idempotent).

    Called by every registered query so results do not depend on the host
    time zone of whoever created the session, and so the executors can
    import this package for the few Python-side operators.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fleetscope`` importable on the executors (once per application).

    The package is zipped on the driver and added with ``addPyFile``; Spark's
    file server distributes it, so executors need no shared folder and no
    installation.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="fleetscope-pkg-"), "fleetscope.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it a cluster session raises, since a temp folder of one machine
    is not seen by the others. A local session without it gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="fleetscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the checkpoint folder that all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder, read back: it cuts the lineage, survives lost
    executors and keeps nothing cached. The files stay until the folder's owner
    clears it, like those of ``checkpoint()``."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
