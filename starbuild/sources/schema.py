"""Schema contracts: export a schema to JSON (text or file), import it, enforce it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def schema_to_json(df: DataFrame | StructType) -> str:
    """The schema (names, types, order, nullability) as JSON text."""
    schema = df.schema if isinstance(df, DataFrame) else df
    return schema.json()


def schema_from_json(text: str) -> StructType:
    """Inverse of ``schema_to_json``."""
    return StructType.fromJson(json.loads(text))


def write_schema(schema: DataFrame | StructType, path: str, spark: SparkSession | None = None) -> str:
    """Write a schema as JSON text to ``path`` (any folder Spark can write, a
    shared one on a cluster) and return the path."""
    spark = spark or schema.sparkSession
    (spark.createDataFrame([(schema_to_json(schema),)], "value string").coalesce(1)
     .write.mode("overwrite").text(path))
    return path


def read_schema(spark: SparkSession, path: str) -> StructType:
    """Inverse of ``write_schema`` (one line of text)."""
    return schema_from_json(spark.read.text(path).where("value <> ''").first()["value"])


def conform(df: DataFrame, schema: StructType, allow_missing: bool = False) -> DataFrame:
    """Reorder, cast and check ``df`` against ``schema`` (``DataFrame.to``).

    A column the schema names but ``df`` lacks raises (``DataFrame.to``
    alone would fill a nullable one with NULL) unless ``allow_missing``;
    impossible casts and nullable data for a non-null field raise at
    analysis time.  Columns the schema does not name are dropped.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing and not allow_missing:
        raise ValueError(f"columns required by the schema are missing: {missing}")
    return df.to(schema)


def nullability_violations(df: DataFrame, schema: StructType) -> DataFrame:
    """NULL counts of the columns ``schema`` declares non-null, as one row
    ``(column, nulls)`` per such column: a data check to re-run after a
    Parquet read-back, where every column comes back nullable."""
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return df.sparkSession.createDataFrame([], "column string, nulls bigint")
    row = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(f"_n{i}")
                   for i, c in enumerate(required)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
        for i, c in enumerate(required)])))
