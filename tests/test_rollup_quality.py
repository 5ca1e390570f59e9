"""Hourly rollup (A1-A5) and quality checks / gate (Q1-Q6)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001

from fleetscope.operators import quality as Q
from fleetscope.operators import rollup as A
from fleetscope.plans import frames

CLEAN_DDL = ("event_id string, timestamp timestamp, device_id string, metric_name string, "
             "value double, unit string, location string")


def clean_df(spark, rows):
    return spark.createDataFrame(rows, CLEAN_DDL)


def row(i, ts, value, eid=None, device="device_001", metric="cpu_usage", loc="us-east-1"):
    return (eid if eid is not None else f"e{i}", ts, device, metric, value, "percent", loc)


def test_single_event_group(spark):
    t = dt.datetime(2026, 4, 2, 14, 30)
    r = A.hourly_aggregates(clean_df(spark, [row(1, t, 12.345)])).first()
    assert r["stddev_value"] is None
    assert r["avg_value"] == r["min_value"] == r["max_value"] == 12.35  # half-up, like Spark
    assert r["hour_window"] == dt.datetime(2026, 4, 2, 14, 0)


def test_tie_rounding_follows_spark(spark):
    t = dt.datetime(2026, 4, 2, 14, 30)
    r = A.hourly_aggregates(clean_df(spark, [row(1, t, 1.01), row(2, t, 1.02)])).first()
    assert r["avg_value"] == 1.02 and r["event_count"] == 2


def test_event_counts_add_up_to_clean_rows(spark):
    clean = frames.clean(spark, SF001)
    agg = A.hourly_aggregates(clean)
    assert agg.agg(F.sum("event_count")).first()[0] == clean.count()


def test_sample_is_ordered_top_k(spark):
    agg = A.hourly_aggregates(frames.clean(spark, SF001))
    s = A.hourly_sample(agg).collect()
    keys = [(r["hour_window"], r["device_id"], r["metric_name"]) for r in s]
    assert len(s) == 10 and keys == sorted(keys)


def checks(df):
    return {r["check"]: (r["passed"], r["detail"]) for r in Q.quality_report(df).collect()}


def test_empty_table_fails_every_check_but_duplicates(spark):
    c = checks(clean_df(spark, []))
    assert c["row_count"] == (False, "Total rows: 0 (threshold: >= 1)")
    assert c["null_rates"] == (False, "No data to check")
    assert c["value_ranges"] == (False, "No data to check")
    assert c["duplicates"][0] is True
    assert Q.gate(Q.quality_report(clean_df(spark, []))).first()["action"] == "alert"


def test_checks_on_fixture_data(spark):
    c = checks(frames.clean(spark, SF001))
    assert c["row_count"][0] is True
    assert c["null_rates"][0] is False and c["null_rates"][1].startswith("location: ")
    assert c["value_ranges"][0] is False and "extremes(>1000): 10" in c["value_ranges"][1]
    assert c["duplicates"][0] is False
    g = Q.gate(Q.quality_report(frames.clean(spark, SF001))).first()
    assert g["action"] == "alert" and g["failed_checks"] == "null_rates,value_ranges,duplicates"


def test_passing_branch(spark):
    t = dt.datetime(2026, 4, 2, 14, 30)
    df = clean_df(spark, [row(i, t, float(i)) for i in range(200)])
    c = checks(df)
    assert all(p for p, _ in c.values())
    assert c["null_rates"][1] == "All columns within threshold"
    assert c["value_ranges"][1] == "Range: [0.00, 199.00], negatives: 0, extremes(>1000): 0"
    assert Q.gate(Q.quality_report(df)).first()["action"] == "aggregate"


def test_null_ids_count_as_duplicates(spark):
    t = dt.datetime(2026, 4, 2, 14, 30)
    df = clean_df(spark, [row(1, t, 1.0, eid=None), row(2, t, 1.0, eid=None), row(3, t, 1.0, eid="x")])
    # the helper turns a None id into "e<i>"; set nulls explicitly
    df = df.withColumn("event_id", F.when(F.col("event_id") == "x", "x"))
    assert checks(df)["duplicates"] == (False, "Total: 3, Unique: 1, Duplicates: 2")


def test_null_rate_threshold_is_strict(spark):
    t = dt.datetime(2026, 4, 2, 14, 30)
    rows = [row(i, t, 1.0, loc=None if i == 0 else "x") for i in range(100)]
    assert checks(clean_df(spark, rows))["null_rates"][0] is True       # exactly 1 %
    rows = [row(i, t, 1.0, loc=None if i < 2 else "x") for i in range(100)]
    assert checks(clean_df(spark, rows))["null_rates"] == (False, "location: 2.00% null (>1%)")


def test_other_widths_use_tumbling_windows(spark):
    t = dt.datetime(2026, 4, 2, 14, 31)
    r = A.hourly_aggregates(clean_df(spark, [row(1, t, 1.0), row(2, t + dt.timedelta(minutes=20), 3.0)]),
                            width="15 minutes").orderBy("hour_window").collect()
    assert [x["hour_window"] for x in r] == [dt.datetime(2026, 4, 2, 14, 30), dt.datetime(2026, 4, 2, 14, 45)]
