"""Order-independent fingerprints of a table's content.

Two tables hold the same rows, each as often, exactly if (up to hash
collisions) their fingerprints are equal: the row count and the sums of two
64-bit row hashes.  Counts and distinct counts cannot see a value that moved
from one row to another; these sums do.  They are ordinary aggregates of long
sums (every hash is cut into four 16-bit parts, so a sum is safe up to 2^47
rows), combined in the map tasks, and can be gathered by ``DataFrame.observe``
while a job runs anyway: no second scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from starbuild.operators.profile import comparable

_SEEDS = (0x5EED, 0xF17)
_NAMES = [f"sum_{i}_{j}" for i in range(len(_SEEDS)) for j in range(4)]


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    sums: tuple[int, ...]

    @classmethod
    def of(cls, found: dict) -> Fingerprint:
        """From the metrics of ``fingerprint_metrics`` (an observation or a row)."""
        return cls(found["content_rows"], tuple(found[n] or 0 for n in _NAMES))

    @property
    def text(self) -> str:
        """Both sums modulo 2^64, in hexadecimal."""
        parts = [sum(s << 16 * j for j, s in enumerate(self.sums[i:i + 4])) for i in (0, 4)]
        return "".join(f"{p % (1 << 64):016x}" for p in parts)


def fingerprint_metrics(values: Sequence[tuple[Column, DataType]]) -> list[Column]:
    """Aggregates of rows made of ``values`` (expression and its type).

    Which values are NULL is hashed as well: Spark's hash passes over NULLs."""
    columns = [comparable(c, t) for c, t in values]
    nulls = [sum((F.when(c.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(columns[at:at + 60])),
                 F.lit(0).cast("long")) for at in range(0, len(columns), 60)]
    out = [F.count(F.lit(1)).alias("content_rows")]
    for i, seed in enumerate(_SEEDS):
        h = F.xxhash64(F.lit(seed), *columns, *nulls)
        out += [F.sum(F.shiftrightunsigned(h, 16 * j).bitwiseAND(F.lit(0xFFFF))).alias(f"sum_{i}_{j}") for j in range(4)]
    return out


def _values(df: DataFrame, columns: Sequence[str] | None) -> list[tuple[Column, DataType]]:
    return [(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns or df.columns]


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> Fingerprint:
    """The fingerprint of a table (one aggregate, one collected row)."""
    return Fingerprint.of(df.agg(*fingerprint_metrics(_values(df, columns))).first().asDict())


def observed_content(df: DataFrame, name: str, columns: Sequence[str] | None = None,
                     values: Sequence[tuple[Column, DataType]] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` that gathers its fingerprint when a job runs over it; read it with
    ``Fingerprint.of(observation.get)``.  ``values`` are other expressions over
    ``df`` than its columns.

    Place it above a range exchange: sampling runs what lies below twice."""
    seen = Observation(name)
    return df.observe(seen, *fingerprint_metrics(values or _values(df, columns))), seen


def content_check(spark, staged: Fingerprint, written: Fingerprint) -> DataFrame:
    """One row: ``rows_staged rows_written rows_equal content_equal``."""
    return spark.createDataFrame([(staged.rows, written.rows, staged.rows == written.rows, staged == written)],
                                 "rows_staged long, rows_written long, rows_equal boolean, content_equal boolean")
