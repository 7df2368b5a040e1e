"""ANSI-safe casts.

Spark 4 runs with ANSI mode on, where a bad cast raises.  Staging data
is dirty by definition, so every cast here is a ``try_cast``: a value
that does not convert becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int_truncated(c: str | Column, to: str = "int", source: DataType | None = None) -> Column:
    """Cast to an integral type, truncating any fraction toward zero.

    Text such as ``'12.7'`` goes through ``double`` first, because
    ``try_cast('12.7' as int)`` is NULL; doubles truncate (``20573.9`` ->
    ``20573``).  Out-of-range values and junk give NULL.
    """
    c = _col(c)
    if isinstance(source, _INTEGRAL):
        return c.try_cast(to)
    # Direct cast first keeps large integral text exact (no trip through
    # a 53-bit mantissa); the double route catches fractional text.
    return F.coalesce(c.try_cast(to), c.try_cast("double").try_cast(to))


def safe_cast(c: str | Column, to: str, source: DataType | None = None) -> Column:
    """``try_cast`` with integral targets truncating like the staging data expects."""
    if to.lower() in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return to_int_truncated(c, to, source)
    return _col(c).try_cast(to)
