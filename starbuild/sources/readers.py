"""Staging readers.

Staging data comes in through any Spark data source (Parquet, CSV, ORC,
JSON, or a third-party format on the classpath).  Text formats should be
read with an explicit schema: schema inference costs an extra pass over
the data and guesses differently per file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_staging(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                 options: Mapping[str, str] | None = None,
                 schema: StructType | str | None = None) -> DataFrame:
    """``spark.read.format(fmt).options(...).load(path)`` with an optional schema."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = ",",
                   header: bool = True, schema: StructType | str | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """Delimited text with a header.

    With ``schema`` the columns are typed on read (values that do not parse
    become NULL in the default PERMISSIVE mode).  With ``columns`` every
    column is read as a string under those names, the raw staging form that
    later casts repair.  With neither, the header names are kept and every
    column is a string (no inference pass).
    """
    reader = (spark.read.option("header", str(header).lower()).option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if schema is None and columns is not None:
        schema = StructType([StructField(c, StringType()) for c in columns])
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows as a lazy frame (a bounded read; never part of a
    transform)."""
    return df.limit(n)


def read_in_chunks(df: DataFrame, max_lines: int, steps: int) -> DataFrame:
    """Bounded read that takes whole chunks of ``steps`` rows until at least
    ``max_lines`` are in: ``ceil(max_lines / steps) * steps`` rows (fewer if
    the source has fewer).  Lazy; Spark stops reading once the limit is met."""
    if steps <= 0 or max_lines < 0:
        raise ValueError("steps must be positive and max_lines non-negative")
    return df.limit(-(-max_lines // steps) * steps)


def sample_rows(df: DataFrame, fraction: float, seed: int, key: Sequence[str]) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of the row key and the
    seed: the same rows in every run, whatever the file splits, and all rows
    of one key or none.  The first 52 bits of ``md5(seed:key)`` are compared
    with the fraction (a NULL key part counts as empty text)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key])
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return df.where(number < F.lit(int(fraction * (1 << 52))))


def checked_rows(part: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """A bounded read as one checked row: ``(read, rows, rows_in_source)``, the
    number of rows returned and how many of them the source holds (duplicates
    counted as often as the source has them)."""
    cols = source.columns
    mine = part.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_m"))
    have = source.groupBy(*[F.col(f"`{c}`").alias(f"_s{i}") for i, c in enumerate(cols)]).agg(F.count(F.lit(1)).alias("_n"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(cols)]
    met = mine.join(have, same, "left")
    zero = F.lit(0).cast("long")
    return met.agg(F.lit(name).alias("read"), F.coalesce(F.sum("_m"), zero).alias("rows"),
                   F.coalesce(F.sum(F.least("_m", F.coalesce("_n", zero))), zero).alias("rows_in_source"))
