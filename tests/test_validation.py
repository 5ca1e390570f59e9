"""Validation and routing on the hand-written edge rows (FIXTURES §4, rows 1-12)."""

from conftest import event, messages_df

from fleetscope.operators import validate as V
from fleetscope.sources.messages import decode

ALL_NULL = ("timestamp is null; unknown device_id: None; value is null; "
            "unknown metric: None")


def outcome(spark, texts):
    val = V.validate(decode(messages_df(spark, texts)))
    routed = V.route_labels(val).collect()
    return [(r["route"], r["rejection_reason"], r["event_id"]) for r in routed]


def test_valid_event_is_clean(spark):
    assert outcome(spark, [event()]) == [("clean", None, "e-1")]


def test_unparseable_text_gets_all_four_reasons(spark):
    res = outcome(spark, ["not-json", None, "[1, 2]"])
    assert res == [("dead_letter", ALL_NULL, "unknown")] * 3


def test_timestamp_rules(spark):
    res = outcome(spark, [event(timestamp="nope"), event(timestamp="2098-12-31T23:59:59Z"),
                          event(timestamp="2099-01-01T00:00:00Z")])
    assert [r[1] for r in res] == ["timestamp is null", None, "timestamp is in the future"]


def test_device_rules(spark):
    res = outcome(spark, [event(device_id="device_051"), event(device_id="device_1")])
    assert [r[1] for r in res] == ["unknown device_id: device_051", "unknown device_id: device_1"]


def test_value_rules(spark):
    res = outcome(spark, [event(value=-146.17), event(value=0), event(value=-0.0),
                          event(value="12.5"), event(value="abc"), event(value=None)])
    assert [r[1] for r in res] == ["negative value: -146.17", None, None,
                                   "value is null", "value is null", "value is null"]


def test_nan_passes_validation(spark):
    assert outcome(spark, ['{"event_id": "n", "timestamp": "2026-04-02T14:30:00Z", '
                           '"device_id": "device_002", "metric_name": "disk_io", "value": NaN}'])[0][0] == "clean"


def test_reasons_in_rule_order(spark):
    res = outcome(spark, [event(metric_name="unknown_probe", value=-1)])
    assert res[0][1] == "negative value: -1.0; unknown metric: unknown_probe"


def test_empty_id_defaults_on_dead_letter(spark):
    res = outcome(spark, [event(event_id="", value=-1)])
    assert res[0][2] == "unknown"


def test_missing_optional_fields_stay_clean(spark):
    res = outcome(spark, [event(event_id=..., unit=..., location=...)])
    assert res[0][0] == "clean" and res[0][2] is None


def test_route_partitions_input(spark):
    from fleetscope.plans import frames
    from conftest import SF001
    val = frames.validated(spark, SF001)
    n = val.count()
    clean, dead = V.clean_side(val).count(), V.dead_side(val).count()
    assert clean + dead == n == 1000


def test_raw_flags_use_their_own_rules(spark):
    msgs = messages_df(spark, [event(value=5000), event(value=50), event(metric_name="unknown_x"),
                               event(timestamp="2099-01-01T00:00:00+00:00")])
    flags = [r["is_anomaly"] for r in V.raw_anomaly_flags(msgs).orderBy("offset").collect()]
    assert flags == [True, False, True, True]
    s = V.raw_anomaly_summary(V.raw_anomaly_flags(msgs)).first()
    assert (s["total"], s["anomalies"], s["anomaly_pct"]) == (4, 3, 75.0)


def test_large_registry_join_matches_inline_list(spark):
    from pyspark.sql import functions as F
    from fleetscope.functions.rules import device_rule
    from fleetscope.schema import DEVICE_IDS
    d = decode(messages_df(spark, [event(device_id="device_050"), event(device_id="device_077")]))
    reg = spark.createDataFrame([(x,) for x in DEVICE_IDS], "device_id string")
    flagged = V.registry_flag(d, reg, "device_id")
    rows = (flagged.select("offset", device_rule(F.col("device_id"), known=F.col("_known")).alias("r"))
            .orderBy("offset").collect())
    assert [r["r"] for r in rows] == [None, "unknown device_id: device_077"]


def test_encode_then_decode_round_trips(spark):
    from fleetscope.sources.messages import encode_events
    rows = [("e1", "2026-04-02T14:30:00Z", "device_003", "disk_io", 12.5, "mbps", None)]
    df = spark.createDataFrame(rows, "event_id string, timestamp string, device_id string, "
                               "metric_name string, value double, unit string, location string")
    back = decode(encode_events(df)).first()
    assert (back["event_id"], back["device_id"], back["value"], back["location"]) == \
        ("e1", "device_003", 12.5, None)
    assert V.validate(decode(encode_events(df))).first()["rejection_reason"] is None


def test_raw_flags_treat_nan_as_in_range(spark):
    nan = ('{"event_id": "n", "timestamp": "2026-04-02T14:30:00Z", "device_id": "device_002", '
           '"metric_name": "disk_io", "value": NaN}')
    assert V.raw_anomaly_flags(messages_df(spark, [nan])).first()["is_anomaly"] is False


def test_negative_value_text_follows_python_float_printing(spark):
    from pyspark.sql import functions as F
    from fleetscope.functions.numeric import python_float_text
    vals = [-146.17, -1.0, -0.01, -0.0005, -1e-05, -1.5e-07, -12345678.9, -100000000.0,
            -1e16, -2.5e20, -0.001, -999999.99]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(python_float_text(F.col("v"))).collect()]
    assert got == [str(v) for v in vals]


def test_keyed_json_body_decodes(spark):
    from fleetscope.sources.messages import encode_events
    rows = [("e1", "2026-04-02T14:30:00Z", "device_003", "disk_io", 12.5, "mbps", "x")]
    df = spark.createDataFrame(rows, "event_id string, timestamp string, device_id string, "
                               "metric_name string, value double, unit string, location string")
    body = encode_events(df, key="device_id")
    assert body.columns == ["key", "value"]
    back = decode(body.select("value")).first()
    assert back["device_id"] == "device_003" and back["value"] == 12.5


def test_infinite_values_print_like_python(spark):
    from pyspark.sql import functions as F
    from fleetscope.functions.numeric import python_float_text
    vals = [float("-inf"), float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(python_float_text(F.col("v"))).collect()] == [str(v) for v in vals]


def test_a_value_with_the_separator_makes_up_no_reasons(spark):
    d = decode(messages_df(spark, [event(device_id="a; b: c; timestamp is null", value=-1), event(value=None)]))
    got = {r["reason"]: r["event_count"] for r in V.rejection_summary(V.validate(d)).collect()}
    assert got == {"unknown device_id": 1, "negative value": 1, "value is null": 1}


def test_raw_flags_call_text_values_normal(spark):
    msgs = messages_df(spark, [event(value="12.5"), event(value="abc"), event(value=None), "not json"])
    assert [r["is_anomaly"] for r in V.raw_anomaly_flags(msgs).orderBy("offset").collect()] == [
        False, False, True, True]
