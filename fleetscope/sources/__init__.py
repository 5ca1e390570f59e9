"""Sources and sinks: given tables, message streams, versioned tables, run logs."""
