"""fleetscope: Spark-native telemetry analytics.

Decode JSON sensor events, validate and route them, roll them up per hour,
check quality, build features, score anomalies and answer catalog, health and
experiment questions -- all as DataFrame-to-DataFrame functions.
"""

__all__ = ["session", "schema"]
