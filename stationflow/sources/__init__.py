"""Readers: files (CSV, JSON lines, Parquet), message topics, catalog tables,
and the adapter that derives station readings from the shared test tables."""
