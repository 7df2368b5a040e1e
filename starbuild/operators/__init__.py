"""Lazy ``DataFrame -> DataFrame`` operators built from Spark expressions."""
