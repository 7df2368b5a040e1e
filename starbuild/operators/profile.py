"""Column profiling as distributed Spark aggregates, in long format
(one row per column), so the result has a fixed schema whatever the
width of the profiled table.

Exact distinct counts are computed per column — ``select(c).distinct()``
for each column, tagged and counted in one final aggregate — rather than as
many ``count(DISTINCT)`` in one aggregate, which makes Spark expand every
row once per distinct column (``Expand``).  Each per-column distinct reads
only its column from a columnar source, hashes a single key, and combines
a hot value inside each map task.  The remaining (non-distinct) metrics
are one aggregate per ``batch`` of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, FractionalType, IntegralType, MapType, NumericType

from starbuild.operators.selection import interpolated, ranks_next_to, values_at_ranks

DEFAULT_BATCH = 64
_QUARTERS = (0.25, 0.5, 0.75)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _batches(items: Sequence[str], size: int) -> list[list[str]]:
    return [list(items[i:i + size]) for i in range(0, len(items), size)]


def _union_all(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no columns to profile")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def comparable(c: Column, dtype: DataType) -> Column:
    """A value that Spark can group and hash: maps, at any depth, become arrays
    of their entries in key order (equal maps give equal arrays); other types
    stay as they are."""
    if "map<" not in dtype.simpleString():
        return c
    if isinstance(dtype, MapType):
        return F.array_sort(F.map_entries(F.transform_values(c, lambda _, v: comparable(v, dtype.valueType))))
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: comparable(x, dtype.elementType))
    return F.when(c.isNotNull(), F.struct(*[comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))


def _group_value(df: DataFrame, c: str) -> Column:
    return comparable(_c(c), df.schema[c].dataType)


def distinct_with_null(c: Column) -> Column:
    """Distinct values of ``c`` with NULL counted as one more value
    (the meaning of ``select(c).distinct().count()``), as one aggregate
    expression."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def stacked_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, v0, v1, ..., n)``: every distinct value of every listed column with
    its rows, in one scan of ``df``.

    Every row gives one ``(column, value)`` pair per column, each value in the slot
    of its own type (maps as sorted entries), combined inside the map tasks."""
    values = {c: _group_value(df, c) for c in columns}
    kinds = list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in columns))
    slot = {c: kinds.index(df.schema[c].dataType.simpleString()) for c in columns}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[(values[c] if k == slot[c] else F.lit(None)).alias(f"v{k}")
                                             for k in range(len(kinds))]) for c in columns])).alias("p")).select("p.*")
    return pairs.groupBy("column", *[f"v{k}" for k in range(len(kinds))]).agg(F.count(F.lit(1)).alias("n"))


def distinct_per_column(df: DataFrame, columns: Sequence[str], count_null: bool = True,
                        name: str = "distinct_values", approx: bool = False,
                        rsd: float = 0.01, one_scan: bool = False) -> DataFrame:
    """``(column, <name>)``: distinct values of each column, NULL counted as
    a value (``count_null``) or ignored.

    Exact (default): one ``distinct`` per column (a partial/final aggregate
    on that column alone), then one small aggregate counting the distinct
    rows per column.  ``approx=True``: HyperLogLog++ sketches
    (``approx_count_distinct`` with relative error ``rsd``) for all columns
    in one aggregate — no value crosses a shuffle, only fixed-size sketches.
    ``one_scan``: exact from one pass over ``df`` for all columns
    (``stacked_counts``); for text sources, where reading one column parses the
    whole line.
    """
    if one_scan and not approx:
        found = stacked_counts(df, columns)
        kinds = [c for c in found.columns if c.startswith("v")]
        there = F.lit(False)
        for c in kinds:
            there = there | F.col(c).isNotNull()
        parts = [found if count_null else found.where(there)]
        return _named_counts(df, columns, parts, name)
    if approx:
        cols = list(columns)
        row = df.agg(*[(F.approx_count_distinct(_group_value(df, c), rsd)
                        + (F.max(F.when(_c(c).isNull(), 1).otherwise(0)) if count_null
                           else F.lit(0))).cast("long").alias(f"_a{i}")
                       for i, c in enumerate(cols)])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").alias(name))
            for i, c in enumerate(cols)])))
    parts = []
    for c in columns:
        v = df.select(_group_value(df, c).alias("_v"))
        if not count_null:
            v = v.filter(F.col("_v").isNotNull())
        parts.append(v.distinct().select(F.lit(c).alias("column")))
    return _named_counts(df, columns, parts, name)


def _named_counts(df: DataFrame, columns: Sequence[str], parts: list[DataFrame], name: str) -> DataFrame:
    counted = _union_all(parts).groupBy("column").agg(F.count(F.lit(1)).alias(name))
    # A column with no (non-null) value has no row above: add it with 0.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").select(
        "column", F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name))


def _long(df: DataFrame, columns: Sequence[str], metrics: dict[str, callable],
          batch: int) -> DataFrame:
    """Evaluate ``metrics[name](column)`` for every column, one aggregate per
    batch of columns, and return rows ``(column, <metric>...)``."""
    frames = []
    for cols in _batches(list(columns), batch):
        aggs = [fn(_c(c)).alias(f"{m}__{i}") for i, c in enumerate(cols)
                for m, fn in metrics.items()]
        row = df.agg(*aggs)
        structs = [F.struct(F.lit(c).alias("column"),
                            *[F.col(f"{m}__{i}").alias(m) for m in metrics])
                   for i, c in enumerate(cols)]
        frames.append(row.select(F.inline(F.array(*structs))))
    return _union_all(frames)


def column_fill_rates(df: DataFrame, columns: Sequence[str] | None = None,
                      scale: int = 1, batch: int = DEFAULT_BATCH) -> DataFrame:
    """Non-null share of every column in percent, banker's-rounded to
    ``scale`` places: ``(column, non_null, rows, fill_pct)``.  One
    aggregate per ``batch`` of columns (one pass for most tables)."""
    prof = _long(df, list(columns or df.columns), {
        "non_null": F.count,
        "rows": lambda c: F.count(F.lit(1)),
    }, batch)
    return prof.select("column", "non_null", "rows",
                       F.bround(F.try_divide(F.col("non_null").cast("double"), F.col("rows"))
                                * 100, scale).alias("fill_pct"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    approx: bool = False, one_scan: bool = False) -> DataFrame:
    """Distinct values per column, NULL counted as a value:
    ``(column, distinct_values)``; ``approx`` uses HyperLogLog++ sketches,
    ``one_scan`` reads ``df`` once (for text sources)."""
    return distinct_per_column(df, list(columns or df.columns), count_null=True, approx=approx, one_scan=one_scan)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   batch: int = DEFAULT_BATCH, approx: bool = False, one_scan: bool = False) -> DataFrame:
    """Rows, unique values (NULL counted) and missing values per column,
    with their shares of the row count:
    ``(column, rows, unique_values, missing, unique_ratio, missing_ratio)``.
    ``one_scan`` as for ``distinct_counts``."""
    cols = list(columns or df.columns)
    df = df.select(*[_value(df, c).alias(c) for c in cols])       # NaN is missing, too
    base = _long(df, cols, {
        "rows": lambda c: F.count(F.lit(1)),
        "missing": lambda c: F.count(F.lit(1)) - F.count(c),
    }, batch)
    prof = base.join(distinct_per_column(df, cols, True, "unique_values", approx, one_scan=one_scan), "column")
    return prof.select("column", "rows", "unique_values", "missing",
                       F.try_divide(F.col("unique_values").cast("double"), F.col("rows"))
                       .alias("unique_ratio"),
                       F.try_divide(F.col("missing").cast("double"), F.col("rows"))
                       .alias("missing_ratio"))


def _value(df: DataFrame, c: str) -> Column:
    """A column with NaN as NULL: both mean a missing value."""
    if isinstance(df.schema[c].dataType, FractionalType) and not isinstance(df.schema[c].dataType, DecimalType):
        return F.when(~F.isnan(_c(c)), _c(c))
    return _c(c)


def _kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type that holds all their values exactly: ``bigint``, the
    decimal type of the column, or ``double``."""
    out: dict[str, list[str]] = {}
    for c in columns:
        t = df.schema[c].dataType
        kind = "bigint" if isinstance(t, IntegralType) else t.simpleString() if isinstance(t, DecimalType) else "double"
        out.setdefault(kind, []).append(c)
    return out


def value_counts(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """``(column, value, m)``: every distinct value of every listed numeric
    column, as ``kind``, with its multiplicity; NULL and NaN are left out.

    One partial/final aggregate per column, keyed by the value alone (a
    narrower hash key than ``(column, value)`` over stacked rows, and with
    a columnar source each reads only its column); a value that holds a
    third of all rows is combined inside each map task.
    """
    parts = [df.select(_value(df, c).cast(kind).alias("value")).filter(F.col("value").isNotNull())
             .groupBy("value").agg(F.count(F.lit(1)).alias("m"))
             .select(F.lit(c).alias("column"), "value", "m")
             for c in columns]
    return _union_all(parts)


def _typed(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    return df.select(*[_value(df, c).cast(kind).alias(c) for c in columns])


def _quantiles(df: DataFrame, ends: dict[str, tuple], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles by column; ``ends`` holds each column's non-null
    rows, smallest and largest value in its own type.  Types are searched at
    the same time."""
    def search(kind: str, names: list[str]) -> dict[str, list[float | None]]:
        typed = _typed(df, names, kind)
        wanted = {c: (*ends[c], ranks_next_to(ends[c][0], probs)) for c in names}
        found = values_at_ranks(typed, typed.schema[0].dataType, wanted)
        return {c: [interpolated({r: v for (name, r), v in found.items() if name == c}, ends[c][0], p) for p in probs]
                for c in names}

    kinds = _kinds(df, list(ends))
    out: dict[str, list[float | None]] = {}
    with ThreadPoolExecutor(max_workers=max(1, len(kinds))) as pool:
        for part in pool.map(lambda k: search(*k), kinds.items()):
            out |= part
    return out


def _ends(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates: non-null rows, smallest and largest value in the type searched."""
    kind = {c: k for k, names in _kinds(df, columns).items() for c in names}
    return [x for i, c in enumerate(columns) for x in (
        F.count(_value(df, c)).alias(f"_n{i}"), F.min(_value(df, c)).cast(kind[c]).alias(f"_lo{i}"),
        F.max(_value(df, c)).cast(kind[c]).alias(f"_hi{i}"))]


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    probs: Sequence[float] = (0.25, 0.5, 0.75),
                    num_partitions: int | None = None) -> DataFrame:
    """Exact interpolated quantiles of numeric columns: ``(column, p, value)``,
    found by repeated histograms (module ``selection``) when called.
    ``num_partitions`` is no longer needed."""
    cols = list(columns)
    row = df.agg(*_ends(df, cols)).first()
    ends = {c: (row[f"_n{i}"], row[f"_lo{i}"], row[f"_hi{i}"]) for i, c in enumerate(cols)}
    found = _quantiles(df, ends, list(probs))
    return df.sparkSession.createDataFrame([(c, float(p), v) for c in cols for p, v in zip(probs, found[c], strict=True)
                                            if v is not None], "column string, p double, value double")


def columns_with_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns holding at least one NULL or NaN: ``(column, missing)`` (one pass)."""
    cols = list(columns or df.columns)
    df = df.select(*[_value(df, c).alias(c) for c in cols])
    return _long(df, cols, {"missing": lambda c: F.count(F.lit(1)) - F.count(c)},
                 batch=max(len(cols), 1)).filter(F.col("missing") > 0)


def _pivots(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """A value near each integral or decimal column's values (from its first
    rows; any value will do)."""
    exact = [c for c in columns if isinstance(df.schema[c].dataType, (IntegralType, DecimalType))]
    if not exact:
        return {}
    row = df.select(*[_c(c) for c in exact]).limit(100).agg(*[F.min(_c(c)).alias(f"p{i}") for i, c in enumerate(exact)]).first()
    return {c: row[i] for i, c in enumerate(exact) if row[i] is not None}


def _moments(c: Column, dtype, pivot) -> dict[str, Column]:
    """Mean and sample standard deviation.

    Deviations of integral and decimal columns are taken from ``pivot``, an
    ordinary value of the column, exactly (as decimals) before they become
    doubles, so values that are large against their spread (epoch
    milliseconds, 64-bit ids) lose nothing; Spark's ``stddev_samp`` then sums
    squares of deviations from the running mean.  A deviation that no decimal
    holds is taken between doubles.  The mean comes from an exact decimal sum;
    if that overflows, from the doubles.
    """
    if pivot is None:
        x = c.cast("double")
        return {"mean": F.avg(x), "std": F.stddev_samp(x)}
    own = dtype if isinstance(dtype, DecimalType) else DecimalType(20, 0)
    exact = c.cast(own)
    apart = F.coalesce(F.try_subtract(exact, F.lit(f"{pivot:f}" if isinstance(dtype, DecimalType) else pivot).cast(own)).cast("double"), c.cast("double") - F.lit(float(pivot)))
    mean = F.try_divide(F.try_sum(exact).cast("double"), F.count(c).cast("double"))
    return {"mean": F.coalesce(mean, F.avg(c.cast("double"))), "std": F.stddev_samp(apart)}


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                    batch: int = DEFAULT_BATCH, digits: int | None = None,
                    approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Numeric describe per column: ``count mean std min q25 q50 q75 max
    unique_values missing`` (NULL and NaN are missing values and enter nothing
    else; ``std`` is the sample deviation; quantiles are exact and linearly
    interpolated, as ``quantile_cont``).  Values are counted and searched in
    their own type; only the results are doubles.

    One scan gives the moments and ends (collected, one row per batch of
    columns), two or three more the quantiles by histograms of fixed size (see
    ``selection``; eager); the distinct counts stay lazy, one aggregate per
    column.

    ``digits`` rounds mean/std/quantiles for display.  ``approx=True``
    takes distinct counts from HyperLogLog++ sketches and quartiles from
    ``percentile_approx`` (``accuracy``), all in the single aggregate pass:
    no shuffle of values, for very large tables where exact ranks are not
    needed.
    """
    cols = list(columns or numeric_columns(df))
    types = {f.name: f.dataType for f in df.schema.fields}
    pivots = _pivots(df, cols)
    rows, ends = [], {}
    for chunk in _batches(cols, batch):
        aggs = _ends(df, chunk)
        for i, c in enumerate(chunk):
            col = _value(df, c)
            m = _moments(col, types[c], pivots.get(c))
            aggs += [m["mean"].alias(f"mean__{i}"), m["std"].alias(f"std__{i}"),
                     F.min(col).cast("double").alias(f"min__{i}"), F.max(col).cast("double").alias(f"max__{i}"),
                     (F.count(F.lit(1)) - F.count(col)).alias(f"missing__{i}")]
            if approx:
                aggs.append(F.percentile_approx(col.cast("double"), F.array(*map(F.lit, _QUARTERS)), accuracy).alias(f"_q{i}"))
        row = df.agg(*aggs).first()
        for i, c in enumerate(chunk):
            ends[c] = (row[f"_n{i}"], row[f"_lo{i}"], row[f"_hi{i}"])
            rows.append([c, row[f"_n{i}"], *[row[f"{m}__{i}"] for m in ("mean", "std", "min", "max", "missing")],
                         *((row[f"_q{i}"] or [None] * 3) if approx else ())])
    if not approx:
        found = _quantiles(df, ends, _QUARTERS)
        rows = [[*r, *found[r[0]]] for r in rows]
    base = df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, max double, "
                                                 "missing long, q25 double, q50 double, q75 double")
    uniq = distinct_per_column(df.select(*[_value(df, c).alias(c) for c in cols]), cols, False, "unique_values", approx)
    return _numeric_out(base.join(uniq, "column"), digits)


def _numeric_out(out: DataFrame, digits: int | None) -> DataFrame:
    def r(c):
        return F.round(F.col(c), digits) if digits is not None else F.col(c)

    return out.select("column", "count", r("mean").alias("mean"), r("std").alias("std"),
                      "min", r("q25").alias("q25"), r("q50").alias("q50"),
                      r("q75").alias("q75"), "max", "unique_values", "missing")


def profile_string(df: DataFrame, columns: Sequence[str] | None = None,
                   batch: int = DEFAULT_BATCH, approx: bool = False, one_scan: bool = False) -> DataFrame:
    """Non-numeric profile per column: ``dtype lines non_null missing fill_pct
    unique_values uniq_pct`` (percentages unrounded, ``unique`` ignores NULL)."""
    cols = list(columns or non_numeric_columns(df))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    base = _long(df, cols, {
        "lines": lambda c: F.count(F.lit(1)),
        "non_null": F.count,
    }, batch).join(distinct_per_column(df, cols, False, "unique_values", approx, one_scan=one_scan), "column")
    dtype = F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))]),
                         F.col("column"))
    return base.select(
        "column", dtype.alias("dtype"), "lines", "non_null",
        (F.col("lines") - F.col("non_null")).alias("missing"),
        (F.try_divide(F.col("non_null").cast("double"), F.col("lines")) * 100).alias("fill_pct"),
        "unique_values",
        (F.try_divide(F.col("unique_values").cast("double"), F.col("lines")) * 100)
        .alias("uniq_pct"))


def _text(df: DataFrame, c: str, value: Column) -> Column:
    """The text of a grouped value; a map's entries read as a map again."""
    if isinstance(df.schema[c].dataType, MapType):
        value = F.map_from_entries(value)
    return value.cast("string")


def low_cardinality_values(df: DataFrame, columns: Sequence[str] | None = None,
                           max_values: int = 10) -> DataFrame:
    """The distinct non-null values (as text) of every column that has at
    most ``max_values`` of them: ``(column, value)``.

    Exact: columns are first ruled out by the number of their distinct 8-byte
    hashes (equal values share a hash, so this can only under-count and never
    drops a column that qualifies); only the survivors' values, few by then,
    are gathered and counted.  The names of the survivors are collected.
    """
    asked = list(columns or df.columns)
    hashes = _union_all([df.select(F.xxhash64(_group_value(df, c)).alias("_h")).filter(_c(c).isNotNull()).distinct()
                         .select(F.lit(c).alias("column")) for c in asked])
    many = {r["column"] for r in hashes.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > max_values).select("column").collect()}
    cols = [c for c in asked if c not in many]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    pairs = _union_all([
        df.select(_group_value(df, c).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
        .select(F.lit(c).alias("column"), _text(df, c, F.col("_v")).alias("value"))
        for c in cols])
    # a list has about max_values entries: its column has that few distinct hashes
    lists = pairs.groupBy("column").agg(F.collect_list("value").alias("_v"))
    return lists.where(F.size("_v") <= max_values).select("column", F.explode("_v").alias("value"))


def group_size_balance(df: DataFrame, key: str) -> DataFrame:
    """Rows per group of ``key``: number of groups, mean group size, the
    largest and smallest group (ties go to the smaller key) and their sizes.
    A single row; the per-group count is a partial/final aggregate."""
    sizes = df.groupBy(_c(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("_n").alias("rows"),
        F.avg("_n").alias("mean_rows"),
        F.min_by("_k", F.struct(-F.col("_n"), F.col("_k"))).alias("largest_group"),
        F.max("_n").alias("largest_rows"),
        F.min_by("_k", F.struct(F.col("_n"), F.col("_k"))).alias("smallest_group"),
        F.min("_n").alias("smallest_rows"))


def latest_value(df: DataFrame, column: str, name: str = "latest") -> DataFrame:
    """Latest (maximum) value of a column as a one-row frame."""
    return df.agg(F.max(_c(column)).alias(name))


def period_overlap(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Covered periods of two date columns and their overlap, in one row:
    ``a_start a_end b_start b_end overlap_start overlap_end overlap_days``
    (``overlap_days`` is NULL when the periods do not meet).  The two
    one-row aggregates are combined by a union and a final aggregate, not a
    cross join."""
    sa = a.agg(F.min(_c(a_col)).cast("date").alias("s"), F.max(_c(a_col)).cast("date").alias("e"))
    sb = b.agg(F.min(_c(b_col)).cast("date").alias("s"), F.max(_c(b_col)).cast("date").alias("e"))
    both = (sa.select(F.lit("a").alias("side"), "s", "e")
            .unionByName(sb.select(F.lit("b").alias("side"), "s", "e")))
    row = both.agg(*[F.max(F.when(F.col("side") == side, F.col(x))).alias(f"{side}_{n}")
                     for side in ("a", "b") for x, n in (("s", "start"), ("e", "end"))])
    start = F.greatest("a_start", "b_start")
    end = F.least("a_end", "b_end")
    return row.select("*", start.alias("overlap_start"), end.alias("overlap_end"),
                      F.when(end >= start, F.datediff(end, start) + 1).alias("overlap_days"))


def summarize(df: DataFrame, kinds: Sequence[str] = ("numbers", "object"),
              examples: int = 10) -> dict[str, DataFrame]:
    """The combined profile: numeric describe, non-numeric profile, columns
    with missing values and the value lists of columns with at most
    ``examples`` distinct values — as lazy frames keyed ``numeric``,
    ``string``, ``missing`` and ``values``."""
    out: dict[str, DataFrame] = {}
    if "numbers" in kinds and numeric_columns(df):
        out["numeric"] = profile_numeric(df)
    if "object" in kinds and non_numeric_columns(df):
        out["string"] = profile_string(df)
    out["missing"] = columns_with_missing(df)
    out["values"] = low_cardinality_values(df, max_values=examples)
    return out
