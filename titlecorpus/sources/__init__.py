"""Scans and sinks: JSON lines, CSV, Parquet, the papers table, named splits."""
