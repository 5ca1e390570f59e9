"""Autoencoder (M1-M5) and report assembly."""

import numpy as np
import pytest

from conftest import SF001

from fleetscope.operators import autoencoder as AE
from fleetscope.operators import scoring as M
from fleetscope.plans import frames
from fleetscope.plans.dataset import prepare
from fleetscope.plans.evaluation import evaluate, run_log
from fleetscope.plans.training import train
from fleetscope.schema import EVALUATION, METRICS, RUN_LOG


def test_parameter_count():
    assert AE.parameter_count() == 5973 == AE.init_params().size


def test_forward_shapes_and_range():
    x = np.random.default_rng(0).random((7, 5))
    y = AE.forward(AE.init_params(seed=1), x)
    assert y.shape == (7, 5) and (y > 0).all() and (y < 1).all()
    assert AE.encode(AE.init_params(seed=1), x).shape == (7, 16)


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(3)
    theta = AE.init_params(seed=2)
    x = rng.random((6, 5))
    _, g = AE.loss_and_grad(theta, x, rng=None)
    idx = rng.choice(theta.size, 40, replace=False)
    eps = 1e-6
    for i in idx:
        tp, tm = theta.copy(), theta.copy()
        tp[i] += eps
        tm[i] -= eps
        num = (AE.loss_and_grad(tp, x)[0] - AE.loss_and_grad(tm, x)[0]) / (2 * eps)
        assert g[i] == pytest.approx(num, rel=1e-4, abs=1e-9)


def test_spark_scoring_matches_numpy(spark):
    theta = AE.init_params(seed=4)
    rows = np.random.default_rng(5).random((50, 5))
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows],
                               ", ".join(f"{m} double" for m in METRICS)).repartition(3)
    got = np.array(sorted(r["error"] for r in
                          M.reconstruction_errors(df, AE.reconstructor(spark, theta)).collect()))
    want = np.sort(np.mean((AE.forward(theta, rows) - rows) ** 2, axis=1))
    assert np.allclose(got, want, rtol=1e-12)


def test_training_reduces_loss_and_reports(spark):
    p = prepare(frames.clean(spark, SF001))
    res = train(spark, p.part("train"), p.part("val"), epochs=6, patience=2)
    assert res.epochs_completed >= 2
    assert res.train_losses[-1] < res.train_losses[0]
    assert res.best_val_loss == min(res.val_losses)
    assert len(res.train_losses) == len(res.val_losses) == res.epochs_completed
    # the in-job validation loss equals an independent scoring pass
    from fleetscope.plans.training import mean_loss
    assert mean_loss(spark, p.part("val"), res.theta) == pytest.approx(res.best_val_loss, rel=1e-9)
    rep = evaluate(spark, p, res.theta, "exp_test")
    assert [f.name for f in rep.schema.fields] == [f.name for f in EVALUATION.fields]
    r = rep.first()
    assert r["thresholds"]["p95"] <= r["thresholds"]["p99"]
    cm = r["confusion_matrix"]
    assert cm["true_positives"] + cm["false_negatives"] == r["dataset"]["synthetic_anomalies"]
    log = run_log(spark, p, res, "exp_test", {"epochs": 6, "lr": 1e-3, "batch_size": 32, "patience": 2})
    assert [f.name for f in log.schema.fields] == [f.name for f in RUN_LOG.fields]
    assert log.first()["hyperparameters"]["epochs_completed"] == res.epochs_completed


def rows_for_training(spark, n, n_val, seed=0):
    x = np.random.default_rng(seed).random((n + n_val, len(METRICS)))
    df = spark.createDataFrame([(*map(float, r), i) for i, r in enumerate(x)],
                               ", ".join(f"{m} double" for m in METRICS) + ", position long").repartition(5)
    return x, df.where(f"position < {n}"), df.where(f"position >= {n}")


def one_process(spark, x, n, epochs, batch_size, seed, dropout, lr=1e-3):
    """The same mini-batches in one plain loop: whole-batch gradients, no lanes of tasks."""
    order = {e: {r.position: r.o for r in spark.range(n).withColumnRenamed("id", "position").select(
        "position", AE.lane_order(seed, e, "position").alias("o")).collect()} for e in range(1, epochs + 1)}
    share = AE.quotas(batch_size)
    theta = AE.init_params(len(METRICS), seed)
    opt, losses, vals = AE.Adam(theta.size, lr=lr), [], []
    for e in range(1, epochs + 1):
        lanes = [sorted((p for p in range(n) if p % len(share) == lane), key=lambda p: (order[e][p], p)) for lane in range(len(share))]
        rngs = [np.random.default_rng([seed, e, lane]) for lane in range(len(share))]
        total = 0.0
        for step in range(max(-(-len(rows) // q) for rows, q in zip(lanes, share))):
            parts = [rows[step * q:(step + 1) * q] for rows, q in zip(lanes, share)]
            batch = x[[p for part in parts for p in part]]
            if dropout:
                sums = [AE.lane_gradient(theta, x[part], rng, dropout) for part, rng in zip(parts, rngs) if part]
                loss, g = (sum(s[k] for s in sums) / batch.size for k in (0, 1))
            else:
                loss, g = AE.loss_and_grad(theta, batch)
            total += loss * len(batch)
            theta = opt.step(theta, g)
        losses.append(total / n)
        vals.append(float(np.mean((AE.forward(theta, x[n:]) - x[n:]) ** 2)))
    return theta, losses, vals


@pytest.mark.parametrize("n,batch_size,dropout", [(203, 32, 0.0), (203, 32, 0.2), (75, 5, 0.0), (61, 100, 0.2), (3, 32, 0.2)])
def test_synchronous_training_equals_one_process(spark, n, batch_size, dropout):
    x, train_df, val_df = rows_for_training(spark, n, 40)
    found = [train(spark, train_df, val_df, epochs=4, patience=9, batch_size=batch_size, tasks=tasks, seed=3, dropout=dropout)
             for tasks in ((1, 2, 4) if n > 3 else (1, 4))]
    theta, losses, vals = one_process(spark, x, n, 4, batch_size, 3, dropout)
    for r in found:
        assert r.epochs_completed == 4
        assert np.allclose(r.train_losses, losses, rtol=0, atol=1e-9) and np.allclose(r.val_losses, vals, rtol=0, atol=1e-9)
        assert r.train_losses == found[0].train_losses and r.val_losses == found[0].val_losses  # to the last bit
        assert (r.theta == found[0].theta).all()
    if found[0].best_epoch == 4:
        assert np.allclose(found[0].theta, theta, rtol=0, atol=1e-9)


def test_empty_training_split_is_refused(spark):
    _, train_df, val_df = rows_for_training(spark, 4, 4)
    with pytest.raises(ValueError):
        train(spark, train_df.limit(0), val_df)


def test_a_missing_task_fails_the_stage_instead_of_hanging(monkeypatch, tmp_root):
    monkeypatch.setattr(AE.SharedSum, "WAIT_SECONDS", 0.1)
    with pytest.raises(TimeoutError):
        AE.SharedSum(f"{tmp_root}/sums", 2, 0).total(0, np.zeros((1, 4)))


def test_training_does_not_depend_on_the_cores(spark):
    """The same losses with two and with eight tasks (full runs: tests/test_entry.py)."""
    import json
    import os
    import subprocess
    import sys
    code = (
        "import json, sys; from fleetscope.session import build_session\n"
        "s = build_session(sys.argv[1], shuffle_partitions=int(sys.argv[2]),"
        " extra={'spark.ui.showConsoleProgress': 'false'})\n"
        "from fleetscope.plans import frames; from fleetscope.plans.dataset import prepare\n"
        "from fleetscope.plans.training import train\n"
        f"p = prepare(frames.clean(s, {SF001!r}))\n"
        "r = train(s, p.part('train'), p.part('val'), epochs=12)\n"
        "print('OUT', json.dumps([r.train_losses, r.val_losses, r.best_epoch, r.epochs_completed]))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = []
    for master, parts in (("local[2]", "4"), ("local[8]", "11")):
        done = subprocess.run([sys.executable, "-c", code, master, parts], cwd=root, timeout=600,
                              capture_output=True, text=True, check=True)
        out.append(json.loads(next(x for x in done.stdout.splitlines() if x.startswith("OUT"))[4:]))
    assert out[0][2:] == out[1][2:]
    assert np.allclose(out[0][0], out[1][0], rtol=0, atol=1e-9)  # the features' means differ in their last bits
    assert np.allclose(out[0][1], out[1][1], rtol=0, atol=1e-9)
    assert out[0][2] == 1 + int(np.argmin(out[0][1]))
