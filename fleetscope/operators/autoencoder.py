"""M1-M3: a 5-64-32-16-32-64-5 autoencoder evaluated inside Spark tasks.

The network is small (5,973 parameters), so its weights travel as one
broadcast vector and every task runs vectorised numpy over Arrow batches
(``mapInPandas``). ReLU between layers, sigmoid on the output, dropout 0.2
after the ReLUs of layers 1, 2, 4 and 5 while training only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from fleetscope.schema import METRICS
from fleetscope.session import ship_package

HIDDEN = (64, 32, 16, 32, 64)
DROPOUT_AFTER = (0, 1, 3, 4)      # layer indexes followed by dropout in training
LATENT_LAYER = 2                   # output of layer 3 (16-d) is the encoding


def layer_sizes(input_dim: int = len(METRICS)) -> list[tuple[int, int]]:
    dims = (input_dim, *HIDDEN, input_dim)
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def parameter_count(input_dim: int = len(METRICS)) -> int:
    return sum(i * o + o for i, o in layer_sizes(input_dim))


def init_params(input_dim: int = len(METRICS), seed: int = 0) -> np.ndarray:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) for weights and biases."""
    rng = np.random.default_rng(seed)
    parts = []
    for i, o in layer_sizes(input_dim):
        k = 1.0 / np.sqrt(i)
        parts += [rng.uniform(-k, k, size=(i, o)).ravel(), rng.uniform(-k, k, size=o)]
    return np.concatenate(parts)


def unpack(theta: np.ndarray, input_dim: int = len(METRICS)):
    out, at = [], 0
    for i, o in layer_sizes(input_dim):
        w = theta[at:at + i * o].reshape(i, o)
        at += i * o
        b = theta[at:at + o]
        at += o
        out.append((w, b))
    return out


def forward(theta: np.ndarray, x: np.ndarray, rng: np.random.Generator | None = None,
            dropout: float = 0.2, keep_cache: bool = False):
    """M1: reconstruction (and, for training, the activations for backprop)."""
    layers = unpack(theta, x.shape[1])
    acts, masks = [x], []
    h = x
    for li, (w, b) in enumerate(layers):
        z = h @ w + b
        if li == len(layers) - 1:
            h = 1.0 / (1.0 + np.exp(-z))
            masks.append(None)
        else:
            h = np.maximum(z, 0.0)
            m = None
            if rng is not None and li in DROPOUT_AFTER and dropout > 0:
                m = (rng.random(h.shape) >= dropout) / (1.0 - dropout)
                h = h * m
            masks.append(m)
        acts.append(h)
    return (h, acts, masks) if keep_cache else h


def encode(theta: np.ndarray, x: np.ndarray) -> np.ndarray:
    """M2: the 16-d latent vector (eval mode)."""
    h = x
    for li, (w, b) in enumerate(unpack(theta, x.shape[1])):
        h = np.maximum(h @ w + b, 0.0)
        if li == LATENT_LAYER:
            return h
    raise AssertionError("unreachable")


def loss_and_grad(theta: np.ndarray, x: np.ndarray, rng: np.random.Generator | None = None,
                  dropout: float = 0.2):
    """MSE over all elements and its gradient w.r.t. the flat parameters."""
    y, acts, masks = forward(theta, x, rng, dropout, keep_cache=True)
    n = x.size
    loss = float(np.mean((y - x) ** 2))
    layers = unpack(theta, x.shape[1])
    grads = [None] * len(layers)
    delta = 2.0 * (y - x) / n * y * (1.0 - y)           # through the sigmoid
    for li in range(len(layers) - 1, -1, -1):
        w, _ = layers[li]
        grads[li] = (acts[li].T @ delta, delta.sum(axis=0))
        if li == 0:
            break
        delta = delta @ w.T
        if masks[li - 1] is not None:
            delta = delta * masks[li - 1]
        delta = delta * (acts[li] > 0)                    # ReLU of layer li-1
    flat = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])
    return loss, flat


class Adam:
    """Adam with PyTorch's defaults (betas 0.9/0.999, eps 1e-8)."""

    def __init__(self, size: int, lr: float = 1e-3, b1: float = 0.9, b2: float = 0.999,
                 eps: float = 1e-8, m=None, v=None, t: int = 0):
        self.lr, self.b1, self.b2, self.eps = lr, b1, b2, eps
        self.m = np.zeros(size) if m is None else np.asarray(m, dtype=float).copy()
        self.v = np.zeros(size) if v is None else np.asarray(v, dtype=float).copy()
        self.t = t

    def step(self, theta: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * g
        self.v = self.b2 * self.v + (1 - self.b2) * g * g
        mh = self.m / (1 - self.b1 ** self.t)
        vh = self.v / (1 - self.b2 ** self.t)
        return theta - self.lr * mh / (np.sqrt(vh) + self.eps)


# --- Spark side ---------------------------------------------------------------

def reconstructor(spark, theta: np.ndarray, metrics: Sequence[str] = METRICS):
    """A scoring.Reconstructor backed by the network (eval mode).

    The weights are broadcast once; each task reconstructs its Arrow batches
    with matrix products, no per-row Python.
    """
    ship_package(spark)
    bc = spark.sparkContext.broadcast(np.asarray(theta, dtype=float))
    metrics = list(metrics)

    def recon(df: DataFrame) -> DataFrame:
        schema = StructType(list(df.schema.fields)
                            + [StructField(f"xhat_{m}", DoubleType()) for m in metrics])

        def run(batches):
            w = bc.value
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                y = forward(w, pdf[metrics].to_numpy(dtype=float))
                out = pdf.copy()
                for j, m in enumerate(metrics):
                    out[f"xhat_{m}"] = y[:, j]
                yield out
        return df.mapInPandas(run, schema)
    return recon


def latent(spark, df: DataFrame, theta: np.ndarray, keep: Sequence[str],
           metrics: Sequence[str] = METRICS) -> DataFrame:
    """M2 over a frame: ``keep`` columns plus ``latent array<double>``."""
    ship_package(spark)
    bc = spark.sparkContext.broadcast(np.asarray(theta, dtype=float))
    keep, metrics = list(keep), list(metrics)
    schema = StructType([df.schema[k] for k in keep]
                        + [StructField("latent", ArrayType(DoubleType()))])

    def run(batches):
        w = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            z = encode(w, pdf[metrics].to_numpy(dtype=float))
            out = pdf[keep].copy()
            out["latent"] = list(z)
            yield out
    return df.select(*keep, *metrics).mapInPandas(run, schema)


#: Lanes into which every mini-batch is cut (fewer for smaller batches); each task trains one or more.
LANES = 8
#: Validation rows scored together.
SCORED = 256

EPOCH_RESULT = StructType([
    StructField("lane", LongType()),
    StructField("val_rows", LongType()),
    StructField("val_sq_sum", DoubleType()),
    StructField("rows", LongType()),
    StructField("sq_sum", DoubleType()),
    StructField("theta", ArrayType(DoubleType())),
    StructField("m", ArrayType(DoubleType())),
    StructField("v", ArrayType(DoubleType())),
    StructField("t", LongType()),
])


def broadcast_state(spark, theta: np.ndarray, opt: Adam):
    """Weights and optimiser state for one epoch (release with ``unpersist``)."""
    ship_package(spark)
    return spark.sparkContext.broadcast((np.asarray(theta, float), opt.m, opt.v, opt.t, opt.lr))


def quotas(batch_size: int) -> list[int]:
    """Rows of each lane in a mini-batch."""
    lanes = min(LANES, batch_size)
    return [batch_size // lanes + (lane < batch_size % lanes) for lane in range(lanes)]


def lane_order(seed: int, epoch: int, key: str = "_key"):
    """The order of a lane's rows in an epoch."""
    return F.xxhash64(F.lit(seed), F.lit(epoch), F.col(key))


def lane_gradient(theta: np.ndarray, x: np.ndarray, rng, dropout: float) -> tuple[float, np.ndarray]:
    """The sum of squared errors of a lane's part of a mini-batch, and its gradient."""
    loss, g = loss_and_grad(theta, x, rng, dropout)
    return loss * x.size, g * x.size


class _Lanes:
    """The rows of a task's lanes, streamed from Arrow batches in the order in which they are sorted.

    Training rows are held until their step; validation rows are scored ``SCORED`` at a time as they pass."""

    def __init__(self, batches, metrics, theta: np.ndarray):
        self.batches, self.metrics, self.theta = batches, metrics, theta
        self.held: dict[tuple[int, bool], np.ndarray] = {}
        self.scores: dict[int, list] = {}

    def _more(self) -> bool:
        pdf = next(self.batches, None)
        if pdf is None:
            return False
        x, lane, val = pdf[self.metrics].to_numpy(dtype=float), pdf["_lane"].to_numpy(), pdf["_val"].to_numpy(dtype=bool)
        for k in {(int(a), bool(b)) for a, b in zip(lane, val)}:
            rows = x[(lane == k[0]) & (val == k[1])]
            self.held[k] = np.concatenate((self.held[k], rows)) if k in self.held else rows
            if k[1]:
                self._score(k[0], SCORED)
        return True

    def _score(self, lane: int, least: int) -> None:
        while len(held := self.held.get((lane, True), ())) >= least:
            x, self.held[lane, True] = held[:SCORED], held[SCORED:]
            at = self.scores.setdefault(lane, [0, 0.0])
            at[0] += len(x)
            at[1] += float(np.sum((forward(self.theta, x) - x) ** 2))

    def take(self, lane: int, n: int) -> np.ndarray:
        """The next ``n`` training rows of a lane."""
        while len(self.held.get((lane, False), ())) < n and self._more():
            pass
        held = self.held.get((lane, False), np.zeros((0, len(self.metrics))))
        self.held[lane, False] = held[n:]
        return held[:n]

    def scored(self, lane: int) -> tuple[int, float]:
        """Validation rows of a lane and the sum of their squared errors, at the end."""
        while self._more():
            pass
        self._score(lane, 1)
        return tuple(self.scores.get(lane, (0, 0.0)))


class SharedSum:
    """All-reduce of the tasks of a barrier stage through files in a shared folder.

    Each task publishes its lanes' vectors for a step under a hidden name, renames the file, and
    reads the files of all tasks. Contents depend on the data and the seed alone, so
    a stage that is run again may meet files of its first attempt. A file is
    removed two steps later, when every task must have read it. (Spark's own ``allGather``
    sleeps for a second at each call.)
    """

    WAIT_SECONDS = 600

    def __init__(self, folder: str, tasks: int, me: int):
        import pyarrow.fs as pafs
        local = folder.startswith(("/", "file:"))
        self.fs, self.folder = ((pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if local
                                else pafs.FileSystem.from_uri(folder))
        self.tasks, self.me = tasks, me
        self.fs.create_dir(self.folder, recursive=True)

    def _name(self, step: int, task: int, hidden: str = "") -> str:
        return f"{self.folder}/{hidden}{step}-{task}"

    def total(self, step: int, vectors: np.ndarray) -> np.ndarray:
        """The sum over all lanes of all tasks, in the order of the lanes (column 0)."""
        with self.fs.open_output_stream(self._name(step, self.me, ".")) as f:
            f.write(np.ascontiguousarray(vectors).tobytes())
        self.fs.move(self._name(step, self.me, "."), self._name(step, self.me))
        parts = [self._read(step, task, vectors.shape[1]) for task in range(self.tasks)]
        if step > 1:
            self.fs.delete_file(self._name(step - 2, self.me))
        rows = np.concatenate(parts)
        out = np.zeros(vectors.shape[1] - 1)
        for i in np.argsort(rows[:, 0]):
            out += rows[i, 1:]
        return out

    def _read(self, step: int, task: int, width: int) -> np.ndarray:
        import time
        name, pause, until = self._name(step, task), 0.0002, time.time() + self.WAIT_SECONDS
        while True:
            try:
                with self.fs.open_input_stream(name) as f:
                    return np.frombuffer(f.read()).reshape(-1, width)
            except FileNotFoundError:
                if time.time() > until:
                    raise TimeoutError(f"task {task} has not published step {step}") from None
                time.sleep(pause)
                pause = min(pause * 1.5, 0.05)


def train_epoch(spark, lanes: DataFrame, sizes: dict[int, int], tasks: int, state, folder: str, epoch: int,
                batch_size: int = 32, seed: int = 0, metrics: Sequence[str] = METRICS,
                dropout: float = 0.2, train_steps: bool = True) -> DataFrame:
    """M3 + M4: one epoch of synchronous mini-batch Adam as one barrier job.

    ``lanes`` holds training and validation rows, dealt by :func:`dealt`; ``sizes`` the
    training rows of every lane. Mini-batch b is the b-th share of each lane, in an order that a hash
    of the row's key and the epoch gives. All tasks run at once; for each mini-batch, each computes the
    gradient of its lanes' rows, the gradients are added over all lanes in a fixed
    order (:class:`SharedSum`), and every task makes the same step. So the losses and weights are those of one
    process over the same batches, to the last bit for any number of tasks. Validation
    rows are scored with the incoming weights. Rows stream through in Arrow batches.
    ``train_steps=False`` only scores. One row for each lane; one of them has the weights.
    """
    metrics = list(metrics)
    present = sorted(sizes)
    share = quotas(batch_size)
    steps = max((-(-n // share[lane]) for lane, n in sizes.items() if n), default=0) if train_steps else 0
    size, dim = parameter_count(len(metrics)), len(metrics)

    def run(batches):
        from pyspark import TaskContext
        me = TaskContext.get().partitionId()
        own = present[me::tasks]
        w0, m, v, t, lr = state.value
        local, w = Adam(len(w0), lr=lr, m=m, v=v, t=t), w0
        rngs = {lane: np.random.default_rng([seed, epoch, lane]) for lane in own}
        rows, shared = _Lanes(batches, metrics, w0), SharedSum(folder, tasks, me) if steps else None
        seen, total = 0, 0.0
        for step in range(steps):
            out = np.zeros((len(own), 3 + size))
            for i, lane in enumerate(own):
                out[i, 0] = lane
                due = min(share[lane], sizes[lane] - step * share[lane])
                if due > 0:
                    x = rows.take(lane, due)
                    out[i, 1] = len(x)
                    out[i, 2], out[i, 3:] = lane_gradient(w, x, rngs[lane], dropout)
            n, sq, g = np.split(shared.total(step, out), [1, 2])
            w = local.step(w, g / (n[0] * dim))
            seen, total = seen + int(n[0]), total + float(sq[0])
        result = [(lane, *rows.scored(lane)) for lane in own]
        first = [me == 0] + [False] * (len(own) - 1)
        yield pd.DataFrame({"lane": [r[0] for r in result], "val_rows": [r[1] for r in result], "val_sq_sum": [r[2] for r in result],
                            "rows": [seen if f else 0 for f in first], "sq_sum": [total if f else 0.0 for f in first],
                            **{name: [a.tolist() if f else None for f in first] for name, a in (("theta", w), ("m", local.m), ("v", local.v))},
                            "t": local.t})
    return (lanes.select(*metrics, "_val", "_key", "_lane").sortWithinPartitions(lane_order(seed, epoch), "_key")
            .mapInPandas(run, EPOCH_RESULT, barrier=True))


def laned(df: DataFrame, batch_size: int = 32) -> DataFrame:
    """Deal rows to lanes by their integer ``_key``: consecutive keys, so all of time, to every lane."""
    return df.withColumn("_lane", F.pmod(F.col("_key"), F.lit(len(quotas(batch_size)))).cast("int"))


def dealt(rows: DataFrame, present: Sequence[int], tasks: int) -> DataFrame:
    """Partitions of whole lanes, one for each task; ``present`` lists the lanes that have rows."""
    place = {lane: i % tasks for i, lane in enumerate(sorted(present))}
    where = F.coalesce(*[F.when(F.col("_lane") == lane, F.lit(p)) for lane, p in place.items()], F.lit(0))
    return rows.repartitionById(tasks, where)
