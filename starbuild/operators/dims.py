"""Dimension builders: entity, group roll-up, date and flag combination.

All four are lazy and shuffle at most once on their own keys; every
aggregate is partial/final (map-side combine), so a key holding a third
of all rows is reduced inside each input task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from starbuild.functions.dates import calendar_parts
from starbuild.functions.strings import split_part
from starbuild.operators.aggregates import weighted_mean_expr
from starbuild.operators.sequence import with_sequence_id


def _c(name: str):
    return F.col(f"`{name}`")


def entity_dimension(df: DataFrame, key: str, columns: Sequence[str],
                     split: tuple[str, str, tuple[str, str]] | None = None,
                     dedupe_key: bool = False) -> DataFrame:
    """Rows with a non-null ``key``, the chosen ``columns``, an optional
    two-way split of one text column, and the key trimmed.

    ``split=(column, separator, (first_name, second_name))`` replaces the
    column by two trimmed parts.  As in the original, duplicates of the key
    are kept unless ``dedupe_key`` is set; then one row per key is kept
    deterministically (the smallest remaining row), via a partial/final
    aggregate rather than an arbitrary ``dropDuplicates``.
    """
    cols = []
    for c in columns:
        if c == key:
            cols.append(F.trim(_c(c)).alias(c))
        elif split is not None and c == split[0]:
            continue
        else:
            cols.append(_c(c))
    if split is not None:
        src, sep, (a, b) = split
        cols += [split_part(_c(src), sep, 0).alias(a), split_part(_c(src), sep, 1).alias(b)]
    out = df.filter(_c(key).isNotNull()).select(*cols)
    if dedupe_key:
        others = [c for c in out.columns if c != key]
        out = (out.groupBy(key).agg(F.min(F.struct(*[_c(c) for c in others])).alias("_r"))
               .select(key, *[F.col(f"_r.`{c}`").alias(c) for c in others]))
    return out


def group_rollup_dimension(df: DataFrame, key: str, sum_columns: Sequence[str],
                           mean_column: str | None = None, weight_column: str | None = None,
                           mean_name: str | None = None, dedupe_rows: bool = True,
                           ignore_weight_of_null: bool = False,
                           dedupe_keys: Sequence[str] | None = None) -> DataFrame:
    """One row per non-null ``key``: sums of ``sum_columns`` (keeping their
    names) and, optionally, the weighted mean ``sum(m*w) / sum(w)`` of
    ``mean_column``.

    Whole-row duplicates are dropped first (``dedupe_rows``).  With
    ``dedupe_keys`` (e.g. ``["state_code", "city"]`` when each city repeats
    once per race category) only one row per key combination is kept — the
    smallest, so the choice is deterministic — before summing.  Sums and the
    weighted mean come from a single ``groupBy().agg()`` — one shuffle, not
    two aggregates and a join.
    """
    src = df.dropDuplicates() if dedupe_rows else df
    if dedupe_keys:
        others = [c for c in src.columns if c not in dedupe_keys]
        src = (src.groupBy(*[_c(k) for k in dedupe_keys])
               .agg(F.min(F.struct(*[_c(c) for c in others])).alias("_r"))
               .select(*[_c(k) for k in dedupe_keys],
                       *[F.col(f"_r.`{c}`").alias(c) for c in others]))
    aggs = [F.sum(_c(c)).alias(c) for c in sum_columns]
    if mean_column is not None:
        aggs.append(weighted_mean_expr(src, mean_column, weight_column, ignore_weight_of_null)
                    .alias(mean_name or mean_column))
    return src.filter(_c(key).isNotNull()).groupBy(_c(key).alias(key)).agg(*aggs)


def _date_column(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """All values of ``columns`` as one ``date`` column (one scan; NULLs kept)."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def as_date(c):
        col = _c(c)
        if isinstance(types[c], (TimestampType, TimestampNTZType)):
            return col.cast("date")
        return col

    return df.select(F.explode(F.array(*[as_date(c) for c in columns])).alias(name))


def date_values(df: DataFrame, columns: Sequence[str], name: str = "datestamp") -> DataFrame:
    """Distinct dates found in any of ``columns`` (one scan for all of them).

    Timestamps are cast to dates.  NULL is a value here; ``date_dimension``
    decides whether to keep it.
    """
    return _date_column(df, columns, name).distinct()


def date_dimension(sources: DataFrame | Sequence[tuple[DataFrame, Sequence[str]]],
                   columns: Sequence[str] | None = None, keep_null: bool = True,
                   name: str = "datestamp") -> DataFrame:
    """Calendar dimension over the distinct dates of several columns.

    ``sources`` is either one DataFrame (with ``columns``) or a list of
    ``(DataFrame, columns)`` pairs.  Each source is scanned once; the union
    is de-duplicated by a single aggregate whose partial step runs in every
    scan task, so only distinct dates per task cross the one shuffle.
    A NULL date stays a row (as in the original) unless ``keep_null=False``.
    """
    if isinstance(sources, DataFrame):
        sources = [(sources, columns)]
    parts = [_date_column(df, cols, name) for df, cols in sources]
    dates = parts[0]
    for p in parts[1:]:
        dates = dates.unionByName(p)
    if not keep_null:
        dates = dates.filter(_c(name).isNotNull())
    dates = dates.distinct()
    return dates.select(_c(name), *[v.alias(k) for k, v in calendar_parts(_c(name)).items()])


def flag_combinations(df: DataFrame, flags: Sequence[str], rows: str = "rows") -> DataFrame:
    """Distinct complete combinations of ``flags`` with the number of rows of
    each (partial sums before the shuffle).  Rows with a NULL flag are left
    out (so they never match in the fact join)."""
    return (df.select(*[_c(f) for f in flags]).dropna(how="any")
            .groupBy(*[_c(f) for f in flags]).agg(F.count(F.lit(1)).alias(rows)))


def rank_combinations(combos: DataFrame, flags: Sequence[str], key: str, start: int = 0,
                      num_partitions: int | None = None) -> DataFrame:
    """Surrogate ``key`` = ``start`` + rank in flag order — deterministic across
    runs and partitionings, unlike ``monotonically_increasing_id`` — computed
    without a single-partition window (see ``with_sequence_id``;
    ``num_partitions`` defaults to the shuffle partition count)."""
    return with_sequence_id(combos.select(*[_c(f) for f in flags]), list(flags), key, start=start,
                            num_partitions=num_partitions)


def extend_combinations(known: DataFrame | None, combos: DataFrame, flags: Sequence[str], key: str,
                        first: int = 0, num_partitions: int | None = None) -> DataFrame:
    """The dimension of an earlier load with the combinations it does not have.

    Rows of ``known`` (``*flags, key``) keep their keys, also those that no row of
    this load uses; the others get ``first``, ``first + 1``, ... in flag order.
    ``first`` is the high-water mark: one above every key that was ever given
    out.  Only combinations (one row each) are joined."""
    if known is None:
        return rank_combinations(combos, flags, key, first, num_partitions)
    known = known.select(*[_c(f) for f in flags], _c(key))
    fresh = combos.join(known, list(flags), "left_anti")
    return known.unionByName(rank_combinations(fresh, flags, key, first, num_partitions))


def combination_dimension(df: DataFrame, flags: Sequence[str], key: str = "status_flag_id",
                          start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Distinct complete combinations of ``flags`` with a surrogate key."""
    return rank_combinations(flag_combinations(df, flags), flags, key, start, num_partitions)
