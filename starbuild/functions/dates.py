"""Date decoding and calendar parts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from starbuild.functions.casts import to_int_truncated

# Fixed value: SAS-style day counts start at 1960-01-01.
EPOCH_1960 = datetime.date(1960, 1, 1)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_days_to_date(c: str | Column, epoch: datetime.date = EPOCH_1960) -> Column:
    """Day count (often a double such as ``20573.0``) -> ``date``.

    The count is truncated to an integer first; the epoch is a date
    literal, so the expression constant-folds and needs no helper column.
    """
    return F.date_add(F.lit(epoch), to_int_truncated(c))


def pattern_to_date(c: str | Column, pattern: str) -> Column:
    """Parse text with a datetime pattern (``MMddyyyy``, ``yyyyMMdd``...).

    Unparseable text gives NULL (``try_to_date``) rather than an error.
    """
    return F.try_to_date(_col(c).cast("string"), pattern)


def calendar_parts(c: str | Column) -> dict[str, Column]:
    """Calendar attributes of a date: ``day_of_month``, ``day_of_year``,
    ISO ``week``, ``month`` and calendar ``year`` (so 2016-01-01 is week 53
    of year 2016, as in the original dimension)."""
    d = _col(c)
    return {
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
    }
