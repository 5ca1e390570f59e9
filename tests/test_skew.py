"""A third of the rows in one group: results stay whole and match brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetscope.operators import quality as Q
from fleetscope.operators import rollup as A
from fleetscope.plans.dataset import prepare
from fleetscope.schema import METRICS

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    base = dt.datetime(2026, 3, 1)
    hot = N // 3
    ts = [base + dt.timedelta(minutes=5, seconds=int(s)) for s in rng.integers(0, 60, hot)]
    ts += [base + dt.timedelta(seconds=int(s)) for s in rng.integers(0, 3 * 86400, N - hot)]
    dev = ["device_001"] * hot + [f"device_{i:03d}" for i in rng.integers(1, 51, N - hot)]
    met = ["cpu_usage"] * hot + list(rng.choice(METRICS, N - hot))
    val = np.round(rng.uniform(0, 100, N), 2)
    pdf = pd.DataFrame({"event_id": [f"e{i}" for i in range(N)], "timestamp": ts, "device_id": dev,
                        "metric_name": met, "value": val, "unit": "percent", "location": "x"})
    df = spark.createDataFrame(pdf).repartition(8)
    return pdf, df


def test_hot_group_rollup_matches_pandas(skewed):
    pdf, df = skewed
    got = A.hourly_aggregates(df).toPandas()
    pdf = pdf.assign(hour_window=pdf["timestamp"].dt.floor("h"))
    want = pdf.groupby(["hour_window", "device_id", "metric_name"])["value"].agg(["count", "min", "max"])
    assert len(got) == len(want)
    assert got["event_count"].sum() == N
    g = got.set_index(["hour_window", "device_id", "metric_name"]).sort_index()
    want = want.sort_index()
    assert (g["event_count"].to_numpy() == want["count"].to_numpy()).all()
    assert np.allclose(g["min_value"].to_numpy(), want["min"].to_numpy())
    assert np.allclose(g["max_value"].to_numpy(), want["max"].to_numpy())
    assert g["event_count"].max() >= N // 3


def test_hot_group_quality_and_pivot(skewed):
    pdf, df = skewed
    rep = {r["check"]: r for r in Q.quality_report(df).collect()}
    assert rep["duplicates"]["detail"] == f"Total: {N}, Unique: {N}, Duplicates: 0"
    p = prepare(df)
    piv = p.pivoted.toPandas().set_index("time_window").sort_index()
    want = (pdf.assign(time_window=pdf["timestamp"].dt.floor("min"))
            .pivot_table(index="time_window", columns="metric_name", values="value", aggfunc="mean"))
    assert len(piv) == len(want)
    for m in METRICS:
        a, b = piv[m].to_numpy(), want[m].reindex(piv.index).to_numpy()
        assert np.allclose(a, b, equal_nan=True)
    sizes = {r["split"]: r["rows"] for r in p.sizes().collect()}
    assert sum(sizes.values()) == len(want)
