"""starbuild — staging tables to a checked star schema, on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst can push filters and column
pruning into the scan and keep the work inside whole-stage codegen.

Sub-packages:

* ``functions`` — column expressions (ANSI-safe casts, date decoding,
  calendar parts, string helpers).
* ``operators`` — column cleanup, dimension and fact builders,
  aggregates, profiling and data-quality checks.
* ``sources``   — readers, Parquet sinks, schema contracts and the
  label-dictionary text job.
* ``plans``     — the end-to-end star build and the query catalog.
"""

__version__ = "0.1.0"
