"""Readers and writers for CSV, GeoJSON, Parquet layers and the run log."""
