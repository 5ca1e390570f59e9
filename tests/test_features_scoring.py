"""Feature preparation (F1-F11) and scoring."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001

from fleetscope.functions.ranking import exact_quantiles, sorted_rank
from fleetscope.operators import features as FT
from fleetscope.operators import scoring as M
from fleetscope.plans import frames
from fleetscope.plans.dataset import prepare
from fleetscope.schema import METRICS

EV_DDL = "timestamp timestamp, device_id string, metric_name string, value double, snapshot_id int"


def minutes(spark, n, metrics=METRICS, const=None):
    base = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        for j, m in enumerate(metrics):
            v = const if const is not None else float(i * 10 + j)
            rows.append((base + dt.timedelta(minutes=i, seconds=5), "device_001", m, v, 1))
    return spark.createDataFrame(rows, EV_DDL)


def test_missing_metric_is_zero_and_scaled_zero(spark):
    p = prepare(minutes(spark, 6, metrics=METRICS[:4]))
    f = p.features.collect()
    assert all(r["network_latency"] == 0.0 for r in f)
    assert all(r["network_latency"] == 0.0 for r in p.normalized.collect())


def test_constant_column_scales_to_zero(spark):
    p = prepare(minutes(spark, 6, const=7.0))
    assert all(r[m] == 0.0 for r in p.normalized.collect() for m in METRICS)


def test_imputation_uses_column_mean(spark):
    df = minutes(spark, 6).where(~((F.col("metric_name") == "cpu_usage")
                                   & (F.minute("timestamp") == 0)))
    f = {r["time_window"].minute: r["cpu_usage"] for r in prepare(df).features.collect()}
    assert f[0] == pytest.approx(np.mean([10, 20, 30, 40, 50]))


@pytest.mark.parametrize("n,sizes", [(5, (3, 1, 1)), (90, (62, 14, 14)), (720, (503, 109, 108))])
def test_split_sizes_truncate_in_doubles(spark, n, sizes):
    p = prepare(minutes(spark, n, metrics=METRICS[:1]))
    got = {r["split"]: r["rows"] for r in p.sizes().collect()}
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == sizes


def test_too_few_vectors_raise(spark):
    with pytest.raises(ValueError):
        prepare(minutes(spark, 4), min_rows=5).features


def test_split_is_chronological(spark):
    s = prepare(frames.clean(spark, SF001)).split.orderBy("position").collect()
    assert [r["position"] for r in s] == list(range(len(s)))
    times = [r["time_window"] for r in s]
    assert times == sorted(times)
    order = {"train": 0, "val": 1, "test": 2}
    labels = [order[r["split"]] for r in s]
    assert labels == sorted(labels)


def test_fit_on_train_differs_from_all(spark):
    clean = frames.clean(spark, SF001)
    a = {r["feature_name"]: r["data_max"] for r in prepare(clean).scaler.collect()}
    t = {r["feature_name"]: r["data_max"] for r in prepare(clean, fit_on="train").scaler.collect()}
    assert all(t[m] <= a[m] for m in METRICS)


def test_ranks_match_python_sort(spark):
    rng = np.random.default_rng(7)
    vals = [float(x) for x in rng.normal(size=500).round(2)]  # has ties
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(7)
    got = sorted((r["_rank"], r["v"]) for r in sorted_rank(df, ["v"]).collect())
    assert [g[0] for g in got] == list(range(500))
    assert [g[1] for g in got] == sorted(vals)


@pytest.mark.parametrize("bracket", [4, 10_000])
@pytest.mark.parametrize("n", [1, 2, 3, 10, 333, 20_000])
def test_exact_quantiles_match_numpy(spark, n, bracket, monkeypatch):
    import fleetscope.functions.ranking as R
    monkeypatch.setattr(R, "BRACKET", bracket)
    monkeypatch.setattr(R, "SKETCH", 200 if bracket == 4 else 10_000)
    rng = np.random.default_rng(n)
    vals = rng.exponential(size=n)
    if n == 20_000:
        vals[rng.random(n) < 0.4] = 1.5   # one value with many rows
    df = spark.createDataFrame([(float(v),) for v in vals], "error double")
    q = exact_quantiles(df, "error", [0.95, 0.99], ["p95", "p99"]).first()
    assert q["p95"] == pytest.approx(np.percentile(vals, 95), rel=1e-12)
    assert q["p99"] == pytest.approx(np.percentile(vals, 99), rel=1e-12)


def test_interpolation_example(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "error double")
    # numpy: position 0.85 * 2 = 1.7 -> 2 + 0.7 * 3 = 4.1; p=0.9 on {1,2,5} gives 4.4
    q = exact_quantiles(df, "error", [0.85], ["q"]).first()["q"]
    assert q == pytest.approx(np.percentile([1, 2, 5], 85))


def test_synthetic_rows_and_metrics(spark):
    syn = M.synthetic_anomalies(spark, 3).collect()
    assert len(syn) == 5
    assert all(0.9 <= r["cpu_usage"] < 1.0 and 0.9 <= r["temperature"] < 1.0 for r in syn)
    assert all(0.0 <= r["memory_usage"] < 1.0 for r in syn)
    cm = spark.createDataFrame([(6, 0, 4, 10)], "true_positives long, false_positives long, "
                               "false_negatives long, true_negatives long")
    d = M.detection_metrics(cm).first()
    assert (d["precision"], d["recall"]) == (1.0, 0.6) and d["f1"] == pytest.approx(0.75)


def test_errors_are_mean_squared_difference(spark):
    df = spark.createDataFrame([(0.0, 0.5, 1.0, 0.25, 0.75)], ", ".join(f"{m} double" for m in METRICS))
    recon = lambda d: d.select("*", *[F.lit(0.5).alias(f"xhat_{m}") for m in METRICS])
    e = M.reconstruction_errors(df, recon).first()["error"]
    assert e == pytest.approx(np.mean((np.array([0, .5, 1, .25, .75]) - .5) ** 2))


def test_keyed_split_orders_by_window_then_key(spark):
    import datetime as _dt
    base = _dt.datetime(2026, 1, 1)
    rows = [(base + _dt.timedelta(minutes=i // 3, seconds=1), f"device_00{i % 3 + 1}", m, float(i), 1)
            for i in range(30) for m in METRICS]
    df = spark.createDataFrame(rows, EV_DDL)
    s = prepare(df, keys=("device_id",)).split.orderBy("position").collect()
    assert [r["position"] for r in s] == list(range(30))
    keys = [(r["time_window"], r["device_id"]) for r in s]
    assert keys == sorted(keys)
    assert [r["split"] for r in s].count("train") == 21


def test_sorted_rank_splits_a_hot_value(spark):
    from pyspark.sql import functions as F
    # a third of the rows share one value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0))
                                  .otherwise(F.col("id").cast("double")).alias("v")).repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep the range partitions apart on tiny data
    try:
        ranked = sorted_rank(df, ["v"])
        assert sorted(r["_rank"] for r in ranked.collect()) == list(range(3000))
        hot = (ranked.where(F.col("v") == 5.0)
               .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.set(key, old)
    assert hot > 1


def test_approx_thresholds_are_close(spark):
    rng = np.random.default_rng(3)
    vals = rng.exponential(size=5000)
    df = spark.createDataFrame([(float(v),) for v in vals], "error double")
    exact = M.thresholds(df).first()
    approx = M.thresholds(df, approx=True).first()
    assert exact["p95"] == pytest.approx(np.percentile(vals, 95), rel=1e-12)
    # the sketch returns an element of the data within its rank error
    assert abs(np.searchsorted(np.sort(vals), approx["p95"]) - 0.95 * 5000) < 5000 * 0.001 + 2


def test_nan_values_are_skipped(spark):
    """One NaN must not reach means, scaler or split; a window of NaN only is no row."""
    base = dt.datetime(2026, 1, 1)
    rows = [(base + dt.timedelta(minutes=i), "device_001", m, float(i), 1) for i in range(10) for m in METRICS]
    rows[0] = (*rows[0][:3], float("nan"), 1)
    rows.append((base + dt.timedelta(minutes=50), "device_001", "cpu_usage", float("nan"), 1))
    p = prepare(spark.createDataFrame(rows, EV_DDL))
    assert p.n == 10 and p.normalized.count() == 10
    values = p.normalized.select(*METRICS).toPandas()
    assert not values.isna().any().any() and values.to_numpy().max() == 1.0
    assert {r["split"]: r["rows"] for r in p.sizes().collect()} == {"train": 7, "val": 1, "test": 2}
    # the cell that was NaN holds the mean of the other nine
    first = p.features.orderBy("time_window").first()
    assert first["cpu_usage"] == pytest.approx(np.mean(range(1, 10))) and first["disk_io"] == 0.0


def test_fit_on_train_imputes_with_train_means_only(spark):
    base = dt.datetime(2026, 1, 1)
    rows = [(base + dt.timedelta(minutes=i), "device_001", m, float(i), 1) for i in range(20) for m in METRICS
            if not (m == "cpu_usage" and i in (3, 18))]
    p = prepare(spark.createDataFrame(rows, EV_DDL), fit_on="train")
    got = {r["position"]: r["cpu_usage"] for r in p.features.collect()}
    assert got[18] == got[3] == pytest.approx(np.mean([i for i in range(14) if i != 3]))
    assert sorted(r["position"] for r in p.split.collect()) == list(range(20))


def test_split_positions_survive_a_dst_change_in_the_driver_zone(spark):
    import os
    import time as _time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "Europe/London"
    _time.tzset()
    try:
        base = dt.datetime(2024, 10, 25)
        rows = [(base + dt.timedelta(minutes=37 * i), "device_001", METRICS[i % 5], float(i), 1)
                for i in range(800)]
        s = prepare(spark.createDataFrame(rows, EV_DDL)).split.collect()
        assert sorted(r["position"] for r in s) == list(range(len(s)))
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        _time.tzset()
