"""Readers, the table layout on Parquet, and sinks."""
