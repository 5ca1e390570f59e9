"""Physical-plan properties that matter at scale (checked on sf0.001 plans)."""

import re

import pytest

from conftest import SF001, event

from fleetscope.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange (\w+)\(?", p)


def test_json_is_parsed_once_per_row(spark):
    p = plan(QUERIES["clean_events"](spark, SF001))
    assert p.count("from_json(") == 1


@pytest.mark.parametrize("name", ["validate_route", "clean_events", "dead_letter",
                                  "hourly_aggregates", "quality_report", "feature_matrix"])
def test_no_python_in_column_paths(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p


def test_rollup_shuffles_aggregated_rows_only(spark):
    """Two keyed exchanges: of the states by key and bin, and of a key's few bins."""
    p = plan(QUERIES["hourly_aggregates"](spark, SF001))
    keyed = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]+)", p) if not e.startswith("xxhash64")]
    assert sorted("bin#" in e for e in keyed) == [False, True]
    assert "partial_sum(s0" in p and "partial_collect_list" in p and "BatchEvalPython" not in p


def test_pivot_is_one_shuffle(spark):
    from fleetscope.plans import frames
    from fleetscope.plans.dataset import prepare
    spark.catalog.clearCache()  # a cached twin would print its own plan too
    p = plan(prepare(frames.clean(spark, SF001)).pivoted)
    keyed = [e for e in re.findall(r"Exchange hashpartitioning\(([^,]+)", p)
             if not e.startswith("xxhash64")]
    assert len(keyed) == 1 and "pivotfirst" not in p


def test_distinct_count_without_expand(spark):
    p = plan(QUERIES["check_duplicates"](spark, SF001))
    assert "Expand" not in p


def test_quality_report_is_one_scan_and_one_keyed_shuffle(spark):
    p = plan(QUERIES["quality_report"](spark, SF001))
    assert p.count("FileScan") == 1 and p.count("from_json(") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(event_id", p)) == 1


def test_confusion_scores_the_synthetic_rows_once(spark):
    p = plan(QUERIES["confusion_matrix"](spark, SF001))
    assert p.count("Range (") == 1 and "Subquery" not in p


def test_no_scan_is_dealt_out_unless_asked(spark):
    assert "REPARTITION_BY_NUM" not in plan(QUERIES["validate_route"](spark, SF001))
    spark.conf.set("spark.fleetscope.scanPartitions", "4")
    try:
        assert "REPARTITION_BY_NUM" in plan(QUERIES["validate_route"](spark, SF001))
    finally:
        spark.conf.unset("spark.fleetscope.scanPartitions")


def test_split_positions_need_no_window_or_day_task(spark):
    spark.catalog.clearCache()
    for name in ("time_split", "device_time_split"):
        p = plan(QUERIES[name](spark, SF001))
        assert "Window" not in p
        spark.catalog.clearCache()


def test_reports_score_each_row_once(spark):
    from fleetscope.plans import registry
    plans = []
    original = registry.AE.reconstructor

    def watched(*args):
        recon = original(*args)

        def run(df):
            plans.append(df)
            return recon(df)
        return run
    registry.AE.reconstructor = watched
    try:
        df = QUERIES["network_report"](spark, SF001)
    finally:
        registry.AE.reconstructor = original
    assert len(plans) == 1 and "MapInPandas" not in plan(df)


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["run_timeline"](spark, SF001))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "props" not in schema and "event_type" not in schema


def test_snapshot_read_prunes_partitions(spark, tmp_root):
    from fleetscope.sources import store
    from fleetscope.streaming.processor import TelemetryProcessor
    proc = TelemetryProcessor(tmp_root)
    for sid in (1, 2, 3):
        proc.process_batch(spark.createDataFrame(
            [(bytearray(event(event_id=f"x{sid}").encode()),)], "value binary"), sid)
    df = store.read_snapshots(spark, tmp_root, "clean_events", as_of=2)
    p = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_id", p)
    assert df.count() == 2


def test_small_sides_are_broadcast_after_a_size_check(spark):
    p = plan(QUERIES["consumer_lag"](spark, SF001))
    assert "BroadcastHashJoin" in p


def test_incremental_rollup_pushes_the_day_range_to_parquet(spark, tmp_root):
    import datetime as dt
    from pyspark.sql import functions as F
    from fleetscope.sources import store
    from fleetscope.streaming.processor import TelemetryProcessor
    TelemetryProcessor(tmp_root).process_batch(spark.createDataFrame(
        [(bytearray(event(event_id="p1").encode()),)], "value binary"), 1)
    clean = store.read_snapshots(spark, tmp_root, "clean_events")
    lo, hi = dt.date(2026, 4, 2), dt.date(2026, 4, 3)
    df = clean.where((F.col("timestamp") >= F.lit(lo).cast("timestamp"))
                     & (F.col("timestamp") < F.lit(hi).cast("timestamp")))
    p = plan(df)
    pushed = p.split("PushedFilters:")[1][:400]  # the list is cut with "..." when long
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThan(timestamp" in pushed
