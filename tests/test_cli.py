"""CLI commands in-process: gate JSON and exit codes, aggregate."""

import json

from conftest import SF001, event

from fleetscope.cli import main
from fleetscope.sources.fixtures import telemetry_messages
from fleetscope.streaming.processor import TelemetryProcessor


def test_gate_alerts_on_faulted_data(spark, tmp_root, capsys):
    TelemetryProcessor(tmp_root).process_batch(telemetry_messages(spark, SF001).select("value"), 1)
    assert main(["gate", "--store", tmp_root]) == 1
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["action"] == "alert" and out["rows_written"] == 0
    assert [c["check"] for c in out["checks"] if not c["passed"]] == \
        ["null_rates", "value_ranges", "duplicates"]


def test_gate_then_aggregate_on_clean_data(spark, tmp_root, capsys):
    texts = [event(event_id=f"c{i}", value=float(i % 90),
                   timestamp=f"2026-04-02T{i % 24:02d}:{i % 60:02d}:00+00:00") for i in range(200)]
    batch = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary")
    TelemetryProcessor(tmp_root).process_batch(batch, 1)
    assert main(["gate", "--store", tmp_root]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["action"] == "aggregate" and out["rows_written"] > 0
    assert main(["aggregate", "--store", tmp_root]) == 0   # nothing new: writes 0
    assert capsys.readouterr().out.strip().splitlines()[-1] == "0"
