"""Readers, Parquet sinks, schema contracts and the dictionary text job."""
