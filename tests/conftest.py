import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fleetscope.session import build_session
    s = build_session("local[4]", app="fleetscope-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="fleetscope-test-")


def messages_df(spark, texts):
    """Kafka-shaped rows from message texts (None = null value)."""
    rows = [(i % 4, i, 1, None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "partition int, offset long, snapshot_id int, value binary")


def event(**kw):
    import json
    base = {"event_id": "e-1", "timestamp": "2026-04-02T14:30:00+00:00", "device_id": "device_001",
            "metric_name": "cpu_usage", "value": 42.5, "unit": "percent", "location": "us-east-1"}
    base.update(kw)
    drop = [k for k, v in base.items() if v is ...]
    for k in drop:
        base.pop(k)
    return json.dumps(base)
