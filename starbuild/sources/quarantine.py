"""Delimited text split into typed rows and rejected lines, in one pass.

A plain staging read turns a value that does not parse into NULL, and nothing
tells it from a value that was not there.  Here every line is parsed once; it
is accepted if it has the right number of fields, every field that is not blank
converts to its column's kind, and no required field is missing.  Other lines
are rejected with their file, their raw text and what failed.  Both kinds are
written by one job, in folders of their own, so accepted rows plus rejected
lines are the lines read, and reading one kind never touches the other.

A record is one line (quoted separators are fine, quoted line breaks are not).
Blank lines are no records, nor are lines that spell the column names (a header,
in each file and however often).  Everything is built-in expressions over the
splittable text source; counts are observed while the lines are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starbuild.functions.casts import safe_cast
from starbuild.functions.dates import epoch_days_to_date, pattern_to_date

FILE, LINE, FAILED, ACCEPTED = "_file", "_line", "_failed", "_accepted"
_FAILURE = "struct<column:string,value:string,reason:string>"
_BAD = "_malformed"


def typed_value(c: Column, kind: str) -> Column:
    """A text as ``kind``: ``string``, a type for ``safe_cast`` (integers take
    fractional text, as the staging casts do), ``epoch_day``, or ``date:`` and a
    pattern.  NULL if it does not convert."""
    if kind == "string":
        return c
    if kind == "epoch_day":
        return epoch_days_to_date(F.trim(c))
    if kind.startswith("date:"):
        return pattern_to_date(F.trim(c), kind.removeprefix("date:"))
    return safe_cast(F.trim(c), kind)


def _spelled(c: Column) -> Column:
    """A header as a column name (see ``normalize_name``)."""
    return F.regexp_replace(F.lower(F.trim(c)), "[ -]", "_")


def checked_lines(lines: DataFrame, kinds: Mapping[str, str], required: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """``(<typed columns>, _file, _line, _failed)`` of every record of ``lines``
    (``file``, ``line``); ``_failed`` lists ``(column, value, reason)`` and is empty
    for a good one.  A line with a wrong number of fields has that one failure
    (``column`` NULL): its values cannot be told to columns."""
    fields = StructType([StructField(n, StringType()) for n in (*kinds, _BAD)])
    parsed = F.from_csv("line", F.lit(fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")),
                        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    rows = lines.where(F.trim("line") != "").select("file", "line", parsed.alias("raw"))
    header = F.lit(True)
    for name in kinds:
        header = header & (_spelled(F.col("raw")[name]) == name.lower())
    rows = rows.where(~F.coalesce(header, F.lit(False)))
    typed, failures = [], []
    for name, kind in kinds.items():
        raw = F.col("raw")[name]
        value = typed_value(raw, kind)
        there = F.coalesce(F.trim(raw) != "", F.lit(False))
        wrong = there & value.isNull()
        failures.append(F.when(wrong, F.struct(F.lit(name).alias("column"), raw.alias("value"), F.lit(f"not a {kind}").alias("reason"))))
        if name in required:
            failures.append(F.when(~there, F.struct(F.lit(name).alias("column"), raw.alias("value"),
                                                    F.lit("required value is missing").alias("reason"))))
        typed.append(value.alias(name))
    count = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"),
                     F.lit(f"not {len(kinds)} fields").alias("reason"))
    failed = F.when(F.col("raw")[_BAD].isNotNull(), F.array(count)).otherwise(F.array_compact(F.array(*failures)))
    return rows.select(*typed, F.col("file").alias(FILE), F.col("line").alias(LINE), failed.cast(f"array<{_FAILURE}>").alias(FAILED))


def read_checked(spark: SparkSession, path: str | list[str], kinds: Mapping[str, str], required: Sequence[str] = (),
                 sep: str = ",") -> DataFrame:
    """``checked_lines`` of text files."""
    return checked_lines(spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")),
                         kinds, required, sep)


@dataclass
class Checked:
    """Accepted rows and rejected lines as they were written."""
    path: str
    columns: StructType
    lines: int
    rejects: int

    def _read(self, spark: SparkSession, accepted: bool) -> DataFrame:
        schema = StructType([*self.columns.fields, StructField(ACCEPTED, StringType())])
        return spark.read.schema(schema).parquet(self.path).where(F.col(ACCEPTED) == str(accepted).lower()).drop(ACCEPTED)

    def accepted(self, spark: SparkSession) -> DataFrame:
        """The typed rows."""
        return self._read(spark, True).drop(FILE, LINE, FAILED)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """``(file, line, failed)`` of the other lines."""
        return self._read(spark, False).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(FAILED).alias("failed"))


def write_checked(checked: DataFrame, path: str, compression: str = "gzip") -> Checked:
    """Writes ``checked_lines`` once, split into accepted rows and rejected lines;
    what a good row needs no more (its raw text) is left out."""
    good = F.size(FAILED) == 0
    seen = Observation("checked")
    rows = (checked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("rejects"))
            .withColumn(ACCEPTED, good.cast("string"))
            .withColumn(FILE, F.when(~good, F.col(FILE))).withColumn(LINE, F.when(~good, F.col(LINE))))
    rows.write.mode("overwrite").option("compression", compression).partitionBy(ACCEPTED).parquet(path)
    found = seen.get
    return Checked(path, checked.schema, found["lines"], found["rejects"])


def failures_by_reason(rejected: DataFrame) -> DataFrame:
    """``(column, reason, lines, example)`` over the rejected lines."""
    each = rejected.select(F.explode("failed").alias("f"), "line")
    return each.groupBy("f.column", "f.reason").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("example"))
