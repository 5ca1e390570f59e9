"""Training-data pipeline operators (deduplication, filters, scans, encoding)."""
