"""Telemetry messages derived from the driver's ``events`` table.

The projection is deterministic so an independent SQL engine can build the
very same message text (see ``fleetscope.oracle``). It plants the fault modes
of a real sensor feed at fixed residues of ``event_id``:

* ``% 100 == 7``  value missing            * ``% 100 == 23`` extreme value (+1000)
* ``% 100 == 41`` timestamp in year 2099   * ``% 100 == 59`` negative value
* ``% 100 == 71`` malformed text           * ``% 100 == 83`` unknown metric
* ``% 100 == 91`` unregistered device      * ``% 250 == 17`` duplicated event id
* ``% 40 == 5``   location missing

``snapshot_id`` (1, 2, 3 for day-of-month <= 10, <= 20, later) stands for the
micro-batch that delivered the message; ``partition``/``offset`` mimic a
4-partition topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.schema import METRIC_UNITS
from fleetscope.sources.tables import read_table, spread

TOPIC = "telemetry.raw"
PARTITIONS = 4
# Places of our own invention; no operator looks at them.
LOCATIONS = tuple(f"hall-{hall}/row-{row}" for hall in "abcd" for row in range(1, 4))

# Fixed mapping of the generator's event types onto the five metrics.
EVENT_TYPE_METRIC = {
    "click": "cpu_usage",
    "view": "memory_usage",
    "purchase": "temperature",
    "signup": "disk_io",
}
DEFAULT_METRIC = "network_latency"
UNKNOWN_METRIC = "unknown_probe"
UNKNOWN_DEVICE = "device_999"
FUTURE_TS = "2099-01-01 00:00:00"
MALFORMED_TEXT = "not-json"


def _case(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == k, F.lit(v)) if expr is None
                else expr.when(key == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def telemetry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed telemetry fields per source event (before JSON encoding)."""
    ev = spread(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id",
                           "event_type", "value"))
    eid = F.col("event_id")
    r100 = eid % 100
    base_metric = _case(F.col("event_type"), EVENT_TYPE_METRIC, DEFAULT_METRIC)
    ts = F.when(r100 == 41, F.lit(FUTURE_TS).cast("timestamp_ntz")).otherwise(F.col("ts"))
    return ev.select(
        (eid % PARTITIONS).cast("int").alias("partition"),
        eid.alias("offset"),
        F.when(F.dayofmonth("ts") <= 10, 1).when(F.dayofmonth("ts") <= 20, 2)
         .otherwise(3).alias("snapshot_id"),
        F.when(eid % 250 == 17, eid - 1).otherwise(eid).cast("string").alias("event_id"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
         .alias("timestamp"),
        F.when(r100 == 91, F.lit(UNKNOWN_DEVICE))
         .otherwise(F.concat(F.lit("device_"),
                             F.lpad((F.col("user_id") % 50 + 1).cast("string"), 3, "0")))
         .alias("device_id"),
        F.when(r100 == 83, F.lit(UNKNOWN_METRIC)).otherwise(base_metric).alias("metric_name"),
        F.when(r100 == 7, F.lit(None).cast("double"))
         .when(r100 == 23, F.round(F.col("value") + 1000, 2))
         .when(r100 == 59, -F.col("value"))
         .otherwise(F.col("value")).alias("value"),
        _case(base_metric, METRIC_UNITS, None).alias("unit"),
        F.when(eid % 40 == 5, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(x) for x in LOCATIONS]),
                                 (F.col("user_id") % len(LOCATIONS) + 1).cast("int")))
         .alias("location"),
        (r100 == 71).alias("malformed"),
    )


def _json_str(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def message_text(df: DataFrame) -> Column:
    """The producer's message text: key order and ``", "``/``": "`` spacing of
    a Python ``json.dumps`` of the event dict; numbers with two decimals."""
    parts = [
        F.lit('{"event_id": '), _json_str(F.col("event_id")),
        F.lit(', "timestamp": '), _json_str(F.col("timestamp")),
        F.lit(', "device_id": '), _json_str(F.col("device_id")),
        F.lit(', "metric_name": '), _json_str(F.col("metric_name")),
        F.lit(', "value": '),
        # Two decimals via a decimal cast (plain text, no exponent; much
        # cheaper than format_string, which also renders a null as "nu").
        F.coalesce(F.col("value").cast("decimal(20,2)").cast("string"), F.lit("null")),
        F.lit(', "unit": '), _json_str(F.col("unit")),
        F.lit(', "location": '), _json_str(F.col("location")),
        F.lit("}"),
    ]
    return F.when(F.col("malformed"), F.lit(MALFORMED_TEXT)).otherwise(F.concat(*parts))


def telemetry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records: partition, offset, snapshot_id, value (bytes)."""
    rows = telemetry_rows(spark, sf_dir)
    return rows.select("partition", "offset", "snapshot_id",
                       message_text(rows).cast("binary").alias("value"))
