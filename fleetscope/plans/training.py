"""M3-M5: the training loop (driver keeps only the weights and two losses).

Each epoch is one barrier job over persisted lanes that hold both splits:
every task scores its validation rows with the weights it received (the
previous epoch's) and takes part in the mini-batch steps, whose gradients are summed over
all tasks (see fleetscope.operators.autoencoder). The validation loss of
epoch e therefore arrives with job e+1, and one scoring-only job closes the
loop; early stopping (patience, strict improvement) and the kept best weights
are exactly those of a separate validation pass -- a stop found one job late
just discards that job's training. A lost executor costs the running epoch.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators import autoencoder as AE
from fleetscope.operators import scoring as M
from fleetscope.schema import METRICS
from fleetscope.session import checkpoint_dir


@dataclass
class TrainResult:
    theta: np.ndarray
    train_losses: list[float] = field(default_factory=list)
    val_losses: list[float] = field(default_factory=list)
    best_val_loss: float = float("inf")
    best_epoch: int = 0
    epochs_completed: int = 0
    seconds: float = 0.0


def mean_loss(spark, df: DataFrame, theta: np.ndarray) -> float:
    """M4: mean squared error over every element (true row mean)."""
    errs = M.reconstruction_errors(df.select(*METRICS), AE.reconstructor(spark, theta))
    v = errs.agg(F.avg("error")).first()[0]
    return float("nan") if v is None else float(v)


def train(spark, train_df: DataFrame, val_df: DataFrame, epochs: int = 50, lr: float = 1e-3,
          patience: int = 5, batch_size: int = 32, tasks: int | None = None,
          seed: int = 0, key: str = "position", dropout: float = 0.2) -> TrainResult:
    """Train to early stopping. ``key``: an integer column that tells the rows of
    both frames apart; with the seed it fixes lanes and mini-batches. ``tasks``: how many run at once
    (default: as many as the cluster has cores for, up to a lane each); the result
    is the same for any number."""
    t0 = time.time()
    both = (train_df.select(*METRICS, F.lit(False).alias("_val"), F.col(key).alias("_key"))
            .unionByName(val_df.select(*METRICS, F.lit(True).alias("_val"), F.col(key).alias("_key"))))
    counts = AE.laned(both, batch_size).groupBy("_lane").agg(F.count_if(~F.col("_val")).alias("n")).collect()  # a row for each lane
    sizes = {r["_lane"]: r["n"] for r in counts}
    if not sum(sizes.values()):
        raise ValueError("empty training split")
    tasks = min(tasks or spark.sparkContext.defaultParallelism, len(sizes))
    data = AE.dealt(AE.laned(both, batch_size), list(sizes), tasks).persist(StorageLevel.MEMORY_AND_DISK)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/gradients-{uuid.uuid4().hex}"
    theta = AE.init_params(len(METRICS), seed)
    opt = AE.Adam(theta.size, lr=lr)
    res = TrainResult(theta.copy())
    waited, pending = 0, None       # pending: (epoch, weights) awaiting their val loss
    dim = float(len(METRICS))

    def settle(val_rows, val_sq) -> bool:
        """Record the pending epoch's validation loss; True when training stops."""
        nonlocal waited
        ep, w = pending
        v = val_sq / (val_rows * dim) if val_rows else float("nan")
        res.val_losses.append(v)
        res.epochs_completed = ep
        if v < res.best_val_loss:
            res.best_val_loss, res.best_epoch, res.theta, waited = v, ep, w.copy(), 0
        else:
            waited += 1
        return waited >= patience or ep >= epochs

    try:
        epoch = 0
        while True:
            epoch += 1
            state = AE.broadcast_state(spark, theta, opt)
            try:
                rows = sorted(AE.train_epoch(spark, data, sizes, tasks, state, f"{folder}/{epoch}", epoch, batch_size, seed,
                                             dropout=dropout, train_steps=epoch <= epochs).collect(), key=lambda r: r["lane"])
            finally:
                state.unpersist()
                _removed(spark, f"{folder}/{epoch}")
            if pending is not None and settle(sum(r["val_rows"] for r in rows), sum(r["val_sq_sum"] for r in rows)):
                break
            last = next(r for r in rows if r["theta"])
            theta, opt.m, opt.v, opt.t = np.array(last["theta"]), np.array(last["m"]), np.array(last["v"]), int(last["t"])
            res.train_losses.append(last["sq_sum"] / (last["rows"] * dim))
            pending = (epoch, theta)
    finally:
        data.unpersist()
    res.train_losses = res.train_losses[:res.epochs_completed]
    res.seconds = round(time.time() - t0, 2)
    return res


def _removed(spark, folder: str) -> None:
    """Remove what the last two steps of an epoch have left in the shared folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
