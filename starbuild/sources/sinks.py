"""Parquet sinks: one folder per table, overwrite, compressed, optionally
partitioned.  Errors propagate (a failed write must fail the job)."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def table_path(root: str, name: str) -> str:
    """``root/name`` for local paths and URIs (``s3a://…``, ``abfss://…``) alike."""
    return root.rstrip("/") + "/" + name if "://" in root else os.path.join(root, name)


#: First character of an escaped partition value, and the folder name that
#: stands for NULL (a fixed value of the file layout).
ESCAPE, NULL_FOLDER = "~", "__HIVE_DEFAULT_PARTITION__"


def partition_text(c: Column) -> Column:
    """A text as a partition value.  Folder names cannot tell the empty text
    from NULL: it, the name that stands for NULL, and texts that start with
    ``ESCAPE`` get an ``ESCAPE`` in front; all other texts stay as they are."""
    odd = (c == "") | c.startswith(ESCAPE) | (c == NULL_FOLDER)
    return F.when(odd, F.concat(F.lit(ESCAPE), c)).otherwise(c)


def plain_text(c: Column) -> Column:
    """Inverse of ``partition_text``."""
    return F.when(c.startswith(ESCAPE), F.substring(c, F.lit(2), F.length(c))).otherwise(c)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  compression: str = "gzip", mode: str = "overwrite",
                  max_records_per_file: int | None = None, cluster: str = "none",
                  observe: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` as Parquet to ``path`` and return the path.

    ``observe`` may attach metrics (``DataFrame.observe``) to the rows as they
    reach the writers, above any exchange, so each row is seen once.

    ``partition_by`` lays the table out by columns so later reads prune
    folders.  ``cluster`` decides how rows reach the writers:

    * ``"none"`` (default, for low-cardinality partition columns such as a
      mode or a month): no shuffle — each task writes files for the values
      it holds.  Task sizes follow the input splits, so a value holding a
      third of all rows causes no skew, and no extra pass is needed;
      there are at most tasks x values files (``max_records_per_file``
      caps their size).
    * ``"range"`` (for high-cardinality partition columns, where tasks x
      values files would be too many): rows are range-clustered on the
      partition columns plus an ``xxhash64`` of the row, so each task
      writes few partition values while a hot value still spreads over many
      tasks; the hash keeps the shuffle deterministic under task retries.
      Range bounds cost one sampling pass over the input.

    Texts in partition columns are written by ``partition_text``, so that the
    empty text does not become NULL; ``read_parquet`` turns them back.
    """
    out = df
    writer_opts = {"compression": compression}
    if max_records_per_file:
        writer_opts["maxRecordsPerFile"] = str(max_records_per_file)
    if partition_by and cluster == "range":
        row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        out = out.repartitionByRange(*[F.col(f"`{c}`") for c in partition_by], row_hash)
    elif cluster not in ("none", "range"):
        raise ValueError(f"unknown cluster mode: {cluster}")
    if observe is not None:
        out = observe(out)
    texts = [c for c in partition_by or () if isinstance(df.schema[c].dataType, StringType)]
    if texts:
        out = out.select(*[partition_text(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])
    w = out.write.mode(mode).options(**writer_opts)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: StructType,
                 partition_by: Sequence[str] | None = None) -> DataFrame:
    """A written table with the types, column order and values it was written
    with; ``partition_by`` as for ``write_parquet``.

    Partition columns live in folder names; a read without a schema guesses
    their types anew (text ``'01'`` would come back as the number 1).  Filters
    on them still prune folders."""
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    back = spark.read.schema(StructType(fields)).parquet(path)
    texts = {f.name for f in fields if f.name in (partition_by or ()) and isinstance(f.dataType, StringType)}
    return back.select(*[plain_text(F.col(f"`{f.name}`")).alias(f.name) if f.name in texts else F.col(f"`{f.name}`")
                         for f in fields])


def write_tables(tables: Mapping[str, DataFrame], root: str,
                 partition_by: Mapping[str, Sequence[str]] | None = None,
                 compression: str = "gzip") -> dict[str, str]:
    """Write each named table to ``root/<name>``; returns ``{name: path}``."""
    partition_by = partition_by or {}
    return {name: write_parquet(df, table_path(root, name), partition_by.get(name),
                                compression=compression)
            for name, df in tables.items()}
