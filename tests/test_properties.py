"""Brute-force checks on random inputs: Spark against plain Python."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import messages_df

from fleetscope.operators import validate as V
from fleetscope.schema import DEVICE_IDS, METRICS
from fleetscope.sources.messages import decode

DEVICES = st.sampled_from([*DEVICE_IDS[:3], "device_000", "device_051", "dev", None])
METRIC = st.sampled_from([*METRICS, "unknown_probe", "", None])
VALUE = st.one_of(st.none(), st.floats(-1e4, 1e4, allow_nan=False).map(lambda v: round(v, 2)))
TS = st.one_of(st.none(), st.just("nope"),
               st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2100, 12, 31))
               .map(lambda d: d.strftime("%Y-%m-%dT%H:%M:%S") + "+00:00"))
EVENT = st.fixed_dictionaries({"event_id": st.one_of(st.none(), st.text("abc", max_size=3)),
                               "timestamp": TS, "device_id": DEVICES, "metric_name": METRIC,
                               "value": VALUE})


def expected_reasons(e: dict) -> str | None:
    """The validation contract stated directly in Python."""
    out = []
    ts = e["timestamp"]
    parsed = None
    if ts is not None and ts != "nope":
        parsed = dt.datetime.fromisoformat(ts)
    if parsed is None:
        out.append("timestamp is null")
    elif parsed.year >= 2099:
        out.append("timestamp is in the future")
    if e["device_id"] not in DEVICE_IDS:
        out.append(f"unknown device_id: {e['device_id']}")
    if e["value"] is None:
        out.append("value is null")
    elif e["value"] < 0:
        out.append(f"negative value: {float(e['value'])}")
    if e["metric_name"] not in METRICS:
        out.append(f"unknown metric: {e['metric_name']}")
    return "; ".join(out) or None


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, min_size=50, max_size=120))
def test_validation_matches_the_contract(spark, events):
    texts = [json.dumps(e) for e in events]
    got = [r["rejection_reason"] for r in
           V.validate(decode(messages_df(spark, texts))).orderBy("offset").collect()]
    assert got == [expected_reasons(e) for e in events]
    routed = V.route_labels(V.validate(decode(messages_df(spark, texts)))).collect()
    assert sum(r["route"] == "clean" for r in routed) == sum(expected_reasons(e) is None for e in events)
