"""Group aggregates: sums that keep their column names and weighted means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, IntegerType, LongType, NumericType, ShortType


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _wide(c: Column, dtype: DataType) -> Column:
    """An integral column as the decimal that holds its type."""
    digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}.get(type(dtype))
    return c if digits is None else c.cast(DecimalType(digits, 0))


def weighted_mean_expr(df: DataFrame, mean_column: str, weight_column: str,
                       ignore_weight_of_null: bool = False) -> Column:
    """``sum(m * w) / sum(w)`` over ``df`` as one aggregate expression.

    By default a row with a NULL mean adds nothing to the numerator but its
    weight still counts in the denominator (the original behaviour);
    ``ignore_weight_of_null`` drops such weights too.  A zero or NULL weight
    sum gives NULL (``try_divide``) instead of an ANSI error.  Integers of any
    size and decimals are multiplied and summed as decimals (exact) and divided
    once as doubles; products or sums that no decimal holds are taken from
    doubles instead.
    """
    m, w = _c(mean_column), _c(weight_column)
    wide_m, wide_w = _wide(m, df.schema[mean_column].dataType), _wide(w, df.schema[weight_column].dataType)
    product = F.try_multiply(wide_m, wide_w)
    lost = F.count(product) < F.count(F.when(m.isNotNull(), w))
    rough = F.sum(m.cast("double") * w.cast("double"))
    num = F.when(lost, rough).otherwise(F.coalesce(F.try_sum(product).cast("double"), rough))
    counted = (lambda x: F.when(m.isNotNull(), x)) if ignore_weight_of_null else (lambda x: x)
    den = F.coalesce(F.try_sum(counted(wide_w)).cast("double"), F.sum(counted(w.cast("double"))))
    return F.try_divide(num, den)


def group_sums(df: DataFrame, keys: str | Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """``groupBy(keys)`` with ``sum`` of every (or every numeric) column,
    each result keeping its source name (``x``, not ``sum(x)``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if f.name not in keys and isinstance(f.dataType, NumericType)]
    return df.groupBy(*[_c(k) for k in keys]).agg(*[F.sum(_c(c)).alias(c) for c in columns])


def weighted_average(df: DataFrame, mean_column: str, weight_column: str,
                     keys: str | Sequence[str], name: str = "weighted_avg",
                     ignore_weight_of_null: bool = False) -> DataFrame:
    """Weighted mean of ``mean_column`` per group, in one aggregate.

    The original ran two aggregates, joined them and round-tripped the
    result through the driver; here it is one ``groupBy().agg()``.
    Groups with a NULL key are dropped, as the original's inner join did.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    kept = df
    for k in keys:
        kept = kept.filter(_c(k).isNotNull())
    return kept.groupBy(*[_c(k) for k in keys]).agg(
        weighted_mean_expr(kept, mean_column, weight_column, ignore_weight_of_null).alias(name))
