"""The hourly table by merging states -- any grouping and order of snapshots gives one rollup's rows."""

import itertools
import os
import random

import pytest

from conftest import event

from fleetscope.operators import rollup as A
from fleetscope.plans import gate
from fleetscope.plans.gate import run_aggregation
from fleetscope.sources import store
from fleetscope.streaming.processor import TelemetryProcessor


def batches(seed, n=3):
    """Events of the same hours spread over all batches: every one changes days of the others."""
    rnd = random.Random(seed)
    return [[event(event_id=f"{b}-{i}", device_id=f"device_{rnd.randint(1, 3):03d}", value=round(rnd.uniform(0, 90), 2),
                   timestamp=f"2026-04-{rnd.randint(1, 3):02d}T{rnd.randint(0, 5):02d}:{rnd.randint(0, 59):02d}:00Z")
             for i in range(120)] for b in range(n)]


def ingest(spark, root, batch_id, texts):
    TelemetryProcessor(root).process_batch(spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary"), batch_id)


def rows(df):
    return sorted(map(tuple, df.select("hour_window", "device_id", "metric_name", "avg_value", "min_value", "max_value",
                                       "stddev_value", "event_count").collect()))


def whole(spark, root):
    return rows(A.hourly_aggregates(store.read_snapshots(spark, root, "clean_events")))


def test_snapshots_merge_in_any_order(spark, tmp_root):
    parts, found = batches(1), []
    for k, order in enumerate(itertools.islice(itertools.permutations(range(3)), 0, 6, 2)):
        root = f"{tmp_root}/{k}"
        for n, b in enumerate(order):
            ingest(spark, root, n, parts[b])
            if n != k % 2:            # one run merges two snapshots at once
                assert run_aggregation(spark, root) > 0
        assert rows(store.read_daily(spark, root)) == whole(spark, root)
        found.append(rows(store.read_daily(spark, root)))
    assert found[0] == found[1] == found[2]


def test_a_rerun_changes_nothing_and_a_rebuild_gives_the_same(spark, tmp_root):
    for n, texts in enumerate(batches(2)):
        ingest(spark, tmp_root, n, texts)
        run_aggregation(spark, tmp_root)
    before = rows(store.read_daily(spark, tmp_root))
    commits = store.commits(spark, tmp_root).count()
    assert run_aggregation(spark, tmp_root) == 0
    assert store.commits(spark, tmp_root).count() == commits
    assert run_aggregation(spark, tmp_root, incremental=False) == len(before)
    assert rows(store.read_daily(spark, tmp_root)) == before
    # states after a rebuild go on from it
    ingest(spark, tmp_root, 9, batches(3, 1)[0])
    run_aggregation(spark, tmp_root)
    assert rows(store.read_daily(spark, tmp_root)) == whole(spark, tmp_root)


def test_a_run_reads_the_new_snapshots_only(spark, tmp_root):
    for n, texts in enumerate(batches(4)):
        ingest(spark, tmp_root, n, texts)
    new = gate.new_events(store.read_snapshots(spark, tmp_root, "clean_events"), 2)
    files = new.inputFiles()
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan and "(snapshot_id#" in plan.split("PartitionFilters")[1]
    run_aggregation(spark, tmp_root, as_of=2)
    assert {p.split("snapshot_id=")[1][0] for p in files} >= {"3"}
    # what older directories hold no longer matters to a run
    for f in ("snapshot_id=1", "snapshot_id=2"):
        for name in os.listdir(f"{tmp_root}/clean_events/{f}"):
            if name.endswith(".parquet"):
                with open(f"{tmp_root}/clean_events/{f}/{name}", "wb") as out:
                    out.write(b"not parquet")
    assert run_aggregation(spark, tmp_root) > 0
    assert sum(r.event_count for r in store.read_daily(spark, tmp_root).collect()) == 360


@pytest.mark.parametrize("where", ["commit", "write_run"])
def test_an_unfinished_run_is_not_seen(spark, tmp_root, monkeypatch, where):
    parts = batches(5)
    ingest(spark, tmp_root, 0, parts[0])
    run_aggregation(spark, tmp_root)
    before = rows(store.read_daily(spark, tmp_root))
    ingest(spark, tmp_root, 1, parts[1])
    whole_fn, calls = getattr(store, where), []

    def stops(*a, **k):
        calls.append(a)
        if where == "commit" or len(calls) == 2:
            raise RuntimeError("lost")
        return whole_fn(*a, **k)
    monkeypatch.setattr(store, where, stops)
    with pytest.raises(RuntimeError):
        run_aggregation(spark, tmp_root)
    monkeypatch.undo()
    assert rows(store.read_daily(spark, tmp_root)) == before
    ingest(spark, tmp_root, 2, parts[2])
    run_aggregation(spark, tmp_root)
    assert rows(store.read_daily(spark, tmp_root)) == whole(spark, tmp_root)


def test_appended_runs_add_rows_until_a_day_is_rewritten(spark, tmp_root):
    parts = batches(6)
    ingest(spark, tmp_root, 0, parts[0])
    n = run_aggregation(spark, tmp_root)
    assert run_aggregation(spark, tmp_root, mode="append") == n
    assert store.read_daily(spark, tmp_root).count() == 2 * n
    ingest(spark, tmp_root, 1, parts[1])
    run_aggregation(spark, tmp_root)
    assert rows(store.read_daily(spark, tmp_root)) == whole(spark, tmp_root)
    store.register_tables(spark, tmp_root, database="incremental_db")
    assert rows(spark.table("incremental_db.hourly_aggregates")) == whole(spark, tmp_root)
