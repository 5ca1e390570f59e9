"""Kept state: the id index, quantile sketches, and that queries keep nothing in memory."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, event, messages_df

from fleetscope.functions.ranking import sorted_rank
from fleetscope.operators import quality as Q
from fleetscope.operators import sketches as K
from fleetscope.operators import validate as V
from fleetscope.plans import frames
from fleetscope.plans.registry import QUERIES
from fleetscope.sources.idindex import IdIndex


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def test_id_index_counts_as_a_scan_does(spark, tmp_root):
    parts = {1: ids(spark, "a", "b", "b", None), 2: ids(spark, "b", "c", None), 3: ids(spark, "d", "a")}
    index = IdIndex(spark, tmp_root, buckets=4)
    assert index.check_duplicates().first().detail == "Total: 0, Unique: 0, Duplicates: 0"
    for n, df in parts.items():
        index.add(df, n)
    index.add(parts[2], 2)             # a replay replaces
    again = IdIndex(spark, tmp_root, buckets=4)   # another session's name for the same files
    for i in (index, again):
        whole = parts[1].union(parts[2]).union(parts[3])
        assert i.check_duplicates().collect() == Q.check_duplicates(whole).collect()
        assert i.check_duplicates(as_of=2).collect() == Q.check_duplicates(parts[1].union(parts[2])).collect()
        new = ids(spark, "a", "x", None, "y", "x")
        assert sorted(r.event_id or "" for r in i.unseen(new).collect()) == ["", "x", "x", "y"]
        assert sorted(r.event_id or "" for r in i.unseen(ids(spark, "c", "d"), as_of=2).collect()) == ["d"]
    for i in (index, again):
        i.drop()


def test_the_stored_ids_are_not_shuffled(spark, tmp_root):
    clean = frames.clean(spark, SF001)
    index = IdIndex(spark, tmp_root, buckets=8)
    index.add(clean.where("snapshot_id = 1"), 1)
    index.add(clean.where("snapshot_id = 2"), 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = plan(index.counts())
        assert "Exchange" not in counted and "Bucketed: true" in counted
        checked = plan(index.check_duplicates())
        assert "hashpartitioning" not in checked       # the total alone is gathered
        joined = plan(index.unseen(clean.where("snapshot_id = 3")))
        assert len(re.findall(r"Exchange hashpartitioning\(event_id", joined)) == 1
        assert joined.index("Exchange hashpartitioning(event_id") < joined.index("Bucketed: true")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        index.drop()


def test_sketches_merge_within_the_rank_error(spark):
    df = spark.range(200000).select((F.col("id") % 7).alias("day"), (F.xxhash64("id") % 100000).cast("double").alias("error"))
    kept = K.kept_sketches(df, ["day"])
    assert kept.count() == 7
    for days in ([0, 1, 2, 3, 4, 5, 6], [2, 5]):
        some = F.col("day").isin(days)
        q = K.merged_quantiles(kept.where(some), [0.5, 0.95, 0.99], ["p50", "p95", "p99"]).first()
        spans = K.rank_spans(df.where(some), "error", {p: q[p] for p in ("p50", "p95", "p99")}).first()
        assert q.n == spans.n
        for name, p in (("p50", .5), ("p95", .95), ("p99", .99)):
            assert spans[f"{name}_below"] <= p + K.RANK_ERROR and spans[f"{name}_upto"] >= p - K.RANK_ERROR
    none = K.merged_quantiles(kept.limit(0), [0.5], ["p50"]).first()
    assert none.n is None and none.p50 is None
    assert K.merged_quantiles(kept, [0.5], ["p50"], by=["day"]).count() == 7


@pytest.mark.parametrize("name", ["time_split", "detection_metrics", "error_thresholds", "apply_scaler", "snapshot_scan",
                                  "check_duplicates_indexed", "threshold_sketch"])
def test_a_dropped_query_leaves_nothing_cached(spark, name):
    spark.catalog.clearCache()
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    tables = {t.name for t in spark.catalog.listTables()}
    before = held()
    QUERIES[name](spark, SF001).collect()
    assert held() == before and spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_snapshot_scan_prunes_directories(spark):
    p = plan(QUERIES["snapshot_scan"](spark, SF001))
    assert re.search(r"PartitionFilters: \[[^]]*snapshot_id#\d+ <= 2", p) and "MapIn" not in p


def test_check_duplicates_reads_once(spark):
    p = plan(QUERIES["check_duplicates"](spark, SF001))
    assert p.count("FileScan") == 1 and p.count("from_json(") == 1


def test_raw_flags_parse_once(spark):
    p = plan(QUERIES["raw_anomaly_flags"](spark, SF001))
    assert p.count("from_json(") == 1 and "get_json_object" not in p


def test_raw_flags_by_the_kind_of_value(spark):
    sent = ["12.5", "1e400", "-1", "0", "1000", "1000.5", "NaN", "true", '"x"', '"5000"', "[5000]", '{"a": 1}', "null",
            "123456789012345678901234567890"]
    head = event(value=...)[:-1]
    msgs = messages_df(spark, [head + f', "value": {v}}}' for v in sent] + [head + "}", "[1]", None, ""])
    got = [r.is_anomaly for r in V.raw_anomaly_flags(msgs).orderBy("offset").collect()]
    assert got == [False, True, True, False, False, True, False, False, False, False, False, False, True, True, True, True, True, True]


def test_equal_keys_get_the_same_positions_in_every_run(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    found = [{(r.k, r.v): r._rank for r in sorted_rank(df.repartition(n).orderBy(F.rand(n)), ["k"]).collect()} for n in (1, 7)]
    assert found[0] == found[1] and sorted(found[0].values()) == list(range(2000))
    same = spark.range(500).select(F.lit(1).alias("k"), F.lit(2).alias("v"))
    assert sorted(r._rank for r in sorted_rank(same, ["k"]).collect()) == list(range(500))
