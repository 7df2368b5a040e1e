"""Column cleanup operators (headers, casts, dates, required columns, layout).

Each operator builds a single ``select`` so the analysed plan stays one
``Project`` deep no matter how many columns change (long ``withColumn``
chains make analysis slow on wide staging tables).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from starbuild.functions.casts import safe_cast
from starbuild.functions.dates import epoch_days_to_date, pattern_to_date
from starbuild.functions.strings import normalize_name, split_part


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Replace (or append) columns in one projection, keeping column order."""
    missing = [c for c in new if c not in df.columns]
    cols = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    cols += [new[c].alias(c) for c in missing]
    return df.select(*cols)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip, lower-case and replace spaces/dashes by ``_`` in every header.

    Raises if two headers normalise to the same name (a silent rename would
    make one of them unreachable).
    """
    names = [normalize_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"headers collide after normalisation: {dupes}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])


def cast_columns(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    """Cast ``columns`` to ``to`` with ANSI-safe semantics (bad values -> NULL;
    integral targets truncate, text like ``'12.7'`` included)."""
    columns = list(columns)
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    types = {f.name: f.dataType for f in df.schema.fields}
    return _replace(df, {c: safe_cast(F.col(f"`{c}`"), to, types[c]) for c in columns})


def decode_epoch_days(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace day counts since 1960-01-01 by dates."""
    return _replace(df, {c: epoch_days_to_date(F.col(f"`{c}`")) for c in columns})


def parse_pattern_dates(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Replace text columns by dates parsed with a per-column pattern,
    e.g. ``{"valid_until": "MMddyyyy", "filed_on": "yyyyMMdd"}``."""
    return _replace(df, {c: pattern_to_date(F.col(f"`{c}`"), p) for c, p in patterns.items()})


def timestamps_to_dates(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast timestamp columns (``TIMESTAMP_NTZ`` included) to ``date``."""
    ts = (TimestampType, TimestampNTZType)
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, ts)]
    return _replace(df, {c: F.col(f"`{c}`").cast("date") for c in columns})


def drop_missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any required column (pushed into the scan)."""
    return df.dropna(how="any", subset=list(required))


def _placeholder(dtype):
    """A typed literal used only to let the optimizer prove non-nullness."""
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, (DateType,)):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, (NumericType, DecimalType)):
        return F.lit(0).cast(dtype)
    raise TypeError(f"no placeholder for {dtype}")


def require_non_null(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows missing a required column and mark those columns
    ``nullable=False`` in the schema — without a Python round trip.

    After the ``dropna`` the ``coalesce`` never fires; it only lets Catalyst
    prove the column non-null, and ``DataFrame.to`` then accepts the
    stricter schema.
    """
    required = list(required)
    kept = drop_missing_required(df, required)
    types = {f.name: f.dataType for f in kept.schema.fields}
    proved = _replace(kept, {c: F.coalesce(F.col(f"`{c}`"), _placeholder(types[c]))
                             for c in required})
    schema = StructType([
        StructField(f.name, f.dataType, nullable=(f.nullable and f.name not in required),
                    metadata=f.metadata)
        for f in proved.schema.fields
    ])
    return proved.to(schema)


def layout_columns(df: DataFrame, layout: Sequence[tuple[str, str | Column, str | None]]) -> list[Column]:
    """The expressions of ``project`` over the columns of ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for target, source, to in layout:
        c = F.col(f"`{source}`") if isinstance(source, str) else source
        src_type = types.get(source) if isinstance(source, str) else None
        if to is not None and not (src_type is not None
                                   and src_type.simpleString() == _type_name(to)):
            c = safe_cast(c, to, src_type)
        out.append(c.alias(target))
    return out


def project(df: DataFrame, layout: Sequence[tuple[str, str | Column, str | None]]) -> DataFrame:
    """Select, rename, cast and reorder in one projection.

    ``layout`` is a list of ``(target_name, source_column_or_expr, type)``;
    ``type`` may be ``None`` to keep the source type, and a cast to the type
    a column already has is skipped.  Columns not listed are dropped.
    """
    return df.select(*layout_columns(df, layout))


def _type_name(to: str) -> str:
    aliases = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint",
               "float": "float", "real": "float"}
    return aliases.get(to.lower(), to.lower())


def split_pair(df: DataFrame, column: str, sep: str, names: tuple[str, str],
               drop_source: bool = True) -> DataFrame:
    """Split ``column`` on ``sep`` into two trimmed string columns.

    A value with one part gives NULL for the second column.
    """
    src = F.col(f"`{column}`")
    first, second = (split_part(src, sep, 0), split_part(src, sep, 1))
    cols = [F.col(f"`{c}`") for c in df.columns if not (drop_source and c == column)]
    return df.select(*cols, first.alias(names[0]), second.alias(names[1]))


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim surrounding spaces of string columns (join keys)."""
    return _replace(df, {c: F.trim(F.col(f"`{c}`")) for c in columns})
