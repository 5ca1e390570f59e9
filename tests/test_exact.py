"""Exact sums: any partitioning, order and merge gives the same bits, and they are the true ones."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF01

from fleetscope.functions import exact
from fleetscope.operators import rollup as A
from fleetscope.plans import frames


def expected(values):
    """Mean and deviation of exact rational arithmetic, rounded once."""
    vs = [Fraction(v) for v in values]
    if not vs:
        return None, None
    total, n = sum(vs), len(vs)
    mean = float(total) / n
    if n < 2:
        return mean, None
    var = (sum(v * v for v in vs) - total * total / n) / (n - 1)
    return mean, math.sqrt(var)


def groups(seed):
    rnd = random.Random(seed)
    out = {
        "cents": [round(rnd.uniform(0, 100), 2) for _ in range(500)],
        "signs": [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 12) for _ in range(300)],
        "cancel": [1e16, 1.0, -1e16, 1e-9] * 50,
        "wide": [rnd.choice([-1, 1]) * 2.0 ** rnd.randint(-400, 400) * rnd.random() for _ in range(60)],
        "powers": [2.0 ** e for e in range(-40, 41)] + [2.0 ** e * (1 - 2 ** -53) for e in range(-40, 41)],
        "constant": [50.1] * 777, "large constant": [1e15 + 0.125] * 300, "near": [1e9 + rnd.random() for _ in range(400)],
        "one": [12.345], "zeros": [0.0, -0.0, 0.0], "tie": [1.01, 1.02], "null": [None], "some null": [None, 2.5, None, 3.5],
    }
    return out


def rows(spark, data, seed, parts):
    flat = [(k, v) for k, vs in data.items() for v in vs]
    random.Random(seed).shuffle(flat)
    return spark.createDataFrame(flat, "k string, value double").repartition(parts)


def bits(df):
    return {r.k: (r.n_rows, r.n_values, None if r.mean is None else r.mean.hex(),
                  None if r.deviation is None else r.deviation.hex(), r.low, r.high) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_are_the_exact_ones_in_any_order(spark, seed):
    data = groups(seed)
    got = [exact.statistics(exact.states(rows(spark, data, s, p), ["k"]), ["k"]) for s, p in ((1, 1), (2, 7), (3, 40))]
    found = {r.k: r for r in got[0].collect()}
    for k, vs in data.items():
        values = [v for v in vs if v is not None]
        mean, deviation = expected(values)
        assert (found[k].n_rows, found[k].n_values) == (len(vs), len(values))
        assert found[k].mean == mean, k
        assert found[k].deviation is deviation is None or found[k].deviation == pytest.approx(deviation, rel=1e-15 if k != "near" else 1e-12, abs=0), k
    assert bits(got[0]) == bits(got[1]) == bits(got[2])


def test_states_merge_in_any_order(spark):
    data = groups(3)
    df = rows(spark, data, 5, 3).withColumn("part", F.abs(F.hash("k", "value")) % 5)
    whole = bits(exact.statistics(exact.states(df, ["k"]), ["k"]))
    parts = [exact.states(df.where(F.col("part") == p), ["k"]) for p in range(5)]
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        state = parts[order[0]]
        for p in order[1:]:
            state = exact.merged(state.unionByName(parts[p]), ["k"])
        assert bits(exact.statistics(state, ["k"])) == whole


def test_values_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    data = {"nan": [1.0, nan], "up": [1.0, inf], "down": [-inf, 2.0], "both": [inf, -inf], "over": [1e200, 2e200], "under": [1e-200, 3e-200],
            "alone": [1e300]}
    df = rows(spark, data, 1, 2)
    got = {r.k: (r.mean, r.deviation) for r in exact.statistics(exact.states(df, ["k"]), ["k"]).collect()}
    want = {r.k: (r.m, r.s) for r in df.groupBy("k").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).collect()}
    same = lambda a, b: a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    assert got["over"] == (want["over"][0], inf)  # the squares overflow
    for k in ("nan", "up", "down", "both", "alone"):
        assert same(got[k][0], want[k][0]) and same(got[k][1], want[k][1]), (k, got[k], want[k])
    assert got["under"] == (0.0, 0.0) or abs(got["under"][1]) < 1e-135
    assert exact.statistics(exact.states(df.limit(0), ["k"]), ["k"]).collect() == []


def test_hourly_rows_do_not_depend_on_partitions(spark):
    clean = frames.clean(spark, SF01)
    got = [sorted(map(tuple, A.hourly_aggregates(clean.repartition(n)).collect())) for n in (1, 8, 200)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 1000
