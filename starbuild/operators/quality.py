"""Data-quality checks as single-pass aggregates.

The original ran one Spark job per number (row counts, distinct counts,
matched and unmatched rows), each rescanning the staging source.  Here a
check is one lazy DataFrame with one result row (or one row per key), so
it costs a scan per input and can be written or collected like any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.operators.profile import comparable, distinct_with_null, stacked_counts


#: Bits of a key filter, in bitmaps of 32,768: at most 8,192 of 4 KB each, 32 MB.
FILTER_BITS = 1 << 28


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _uniq(c: Column, approx: bool, rsd: float) -> Column:
    if not approx:
        return distinct_with_null(c)
    return (F.approx_count_distinct(c, rsd)
            + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long")


def key_counts(df: DataFrame, columns: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """``(column, rows, uniq)``: row count and distinct values (NULL counted as
    one) of several key columns in one scan of ``df``.

    Exact: every row gives one small ``(column, value)`` pair per column, each
    value in its own type (as ``distinct_counts`` does: 0.0 equals -0.0, an hour
    that a zone repeats is two timestamps), combined inside the map tasks, so
    columns with few values (dates) cost next to nothing beside the one key that
    is shuffled anyway.
    ``approx`` estimates with HyperLogLog++ (relative error ``rsd``) and
    shuffles no keys."""
    if approx:
        row = df.agg(F.count(F.lit(1)).alias("n"), *[_uniq(_c(c), True, rsd).alias(f"u{i}") for i, c in enumerate(columns)])
        return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("rows"),
                                                      F.col(f"u{i}").alias("uniq")) for i, c in enumerate(columns)])))
    found = (stacked_counts(df, columns).groupBy("column")
             .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("uniq")))
    # a table without rows has counts of zero
    none = df.sparkSession.createDataFrame([(c, 0, 0) for c in columns], "column string, rows long, uniq long")
    return found.unionByName(none).groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("uniq").alias("uniq"))


def reconcile_counts(stage: DataFrame, stage_key: str, output: DataFrame,
                     output_key: str, approx: bool = False, rsd: float = 0.01,
                     stage_counts: DataFrame | None = None) -> DataFrame:
    """Row counts and key uniqueness of a staging table and its output.

    One row: ``stage_rows output_rows row_diff stage_unique output_unique
    keys_equal duplicates`` where ``*_unique`` counts distinct keys with
    NULL as a value, ``keys_equal`` compares the two, and ``duplicates`` is
    ``output_rows - output_unique`` (kept separate from ``keys_equal``).

    Exact by default (a shuffle of the distinct keys).  ``approx=True``
    estimates the distinct keys with HyperLogLog++ (relative error
    ``rsd``): one pass, no key shuffle; the verdicts are then estimates.
    ``stage_counts`` (from ``key_counts``) saves the scan of ``stage``.
    """
    if stage_counts is None:
        stage_counts = key_counts(stage, [stage_key], approx, rsd)
    s = stage_counts.where(F.col("column") == stage_key)
    o = key_counts(output, [output_key], approx, rsd)
    both = (s.select(F.lit("s").alias("side"), "rows", "uniq")
            .unionByName(o.select(F.lit("o").alias("side"), "rows", "uniq")))
    row = both.agg(*[F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{name}_{m}")
                     for side, name in (("s", "stage"), ("o", "output")) for m in ("rows", "uniq")])
    return row.select(
        F.col("stage_rows"), F.col("output_rows"),
        (F.col("stage_rows") - F.col("output_rows")).alias("row_diff"),
        F.col("stage_uniq").alias("stage_unique"), F.col("output_uniq").alias("output_unique"),
        (F.col("stage_uniq") == F.col("output_uniq")).alias("keys_equal"),
        (F.col("output_rows") - F.col("output_uniq")).alias("duplicates"))


def _fk_pair_counts(fact: DataFrame, fact_col: str, id_col: str | None,
                    distinct_pairs: bool = True) -> DataFrame:
    """Distinct ``(id, trimmed fk)`` pairs of the fact, counted per fk.

    The de-duplication and the per-fk count are both partial/final
    aggregates, so a hot fk value is combined inside each map task; what
    meets the dimension afterwards is one row per distinct fk.  With
    ``distinct_pairs=False`` (for an ``id`` known to be unique, e.g. after
    ``reconcile_counts`` reported no duplicates) every row is one pair and
    the pair shuffle is skipped: only per-fk partial counts cross it.
    """
    fk = F.trim(_c(fact_col)).alias("fk")
    if not distinct_pairs:
        return fact.groupBy(fk).agg(F.count(F.lit(1)).alias("pairs"))
    id_col = id_col or fact.columns[0]
    pairs = fact.select(_c(id_col).alias("_id"), fk).distinct()
    return pairs.groupBy("fk").agg(F.count(F.lit(1)).alias("pairs"))


def _dim_keys(dim: DataFrame, dim_col: str) -> DataFrame:
    return dim.select(_c(dim_col).alias("_dk")).filter(F.col("_dk").isNotNull()).distinct()


def join_coverage(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str,
                  id_col: str | None = None, scale: int = 1,
                  distinct_pairs: bool = True) -> DataFrame:
    """How many distinct ``(id, fk)`` pairs of the fact find their key in
    the dimension: ``matched unmatched total matched_pct``.

    Matching is tested on the dimension side of a left join against the
    distinct dimension keys, so duplicate dimension keys cannot inflate the
    counts and a NULL fk counts as unmatched.  ``id`` defaults to the first
    fact column.
    """
    per_fk = _fk_pair_counts(fact, fact_col, id_col, distinct_pairs)
    tagged = per_fk.join(_dim_keys(dim, dim_col), F.col("fk") == F.col("_dk"), "left")
    row = tagged.agg(
        F.coalesce(F.sum(F.when(F.col("_dk").isNotNull(), F.col("pairs"))), F.lit(0))
        .alias("matched"),
        F.coalesce(F.sum(F.when(F.col("_dk").isNull(), F.col("pairs"))), F.lit(0))
        .alias("unmatched"))
    total = F.col("matched") + F.col("unmatched")
    return row.select("matched", "unmatched", total.alias("total"),
                      F.bround(F.try_divide(F.col("matched").cast("double"), total) * 100, scale)
                      .alias("matched_pct"))


def unmatched_keys(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str,
                   id_col: str | None = None, top: int | None = 20,
                   distinct_pairs: bool = True, counters: bool = False) -> DataFrame:
    """Fact keys with no dimension row, ranked by how many distinct
    ``(id, fk)`` pairs carry them: ``(fk, pairs)``, largest first, ties by
    key (NULL last).  ``top`` keeps the first rows of the ranking (the
    report's purpose); ``None`` returns all of them.

    ``counters`` (with ``top`` and unique ids, ``distinct_pairs=False``) takes the
    same rows from ``top_keys``: for billions of unmatched keys and a dimension
    that is small enough to be broadcast, no count per key is shuffled."""
    if counters and top is not None and not distinct_pairs:
        keys = fact.select(F.trim(_c(fact_col)).alias("fk"))
        missing = keys.join(_dim_keys(dim, dim_col), F.col("fk") == F.col("_dk"), "left_anti")
        return top_keys(missing, "fk", top).select(F.col("key").alias("fk"), F.col("rows").alias("pairs"))
    per_fk = _fk_pair_counts(fact, fact_col, id_col, distinct_pairs)
    missing = per_fk.join(_dim_keys(dim, dim_col), F.col("fk") == F.col("_dk"), "left_anti")
    ranked = missing.orderBy(F.desc("pairs"), F.asc_nulls_last("fk"))
    return ranked.limit(top) if top is not None else ranked


def key_filter(hashes: DataFrame, column: str) -> DataFrame:
    """``(bucket, bits)``: a bit for every 64-bit hash of ``column``, in bitmaps
    by bucket (only buckets that have a bit).  At most 32 MB whatever the input;
    n different hashes let a share of n / 2^28 of all others pass."""
    slot = F.pmod(F.col(column), F.lit(FILTER_BITS))
    return (hashes.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("bits")))


def passing(df: DataFrame, column: str, filter_: DataFrame) -> DataFrame:
    """Rows of ``df`` whose hash may be one of the filter's (all of them, and few
    others).  The bitmaps are broadcast and joined by bucket, so the other rows
    stop in the task that reads them."""
    slot = F.pmod(F.col(column), F.lit(FILTER_BITS))
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    bits = filter_.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    return (df.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("_bucket")).where(found)
            .drop("_bucket", "_bits"))


def hidden_duplicates(df: DataFrame, columns: Sequence[str], min_count: int = 2) -> DataFrame:
    """Groups of rows sharing the same values in ``columns``:
    ``(*columns, copies)`` for groups of at least ``min_count`` rows.

    Exact, and wide values (long texts) of rows without a copy hardly ever
    cross a shuffle: rows are first counted by a 64-bit and an independent
    32-bit hash of the key columns (12 bytes per row shuffled, partial/final
    aggregate).  Hashes with ``min_count`` rows make a bit filter (at most 32 MB,
    see ``key_filter``) that stops the other rows inside the map tasks; of 10 M
    candidates' filter 4 % of them pass.  What passes is grouped on hashes and
    real values, which removes collisions; copies of one text, however many, are
    combined in each map task first.  Equal values always share both hashes, so
    no group is missed.
    """
    cols = [_c(c) for c in columns]
    hashed = df.select(*cols, F.xxhash64(*cols).alias("_h1"), F.hash(*cols).alias("_h2"))
    candidates = (hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
                  .filter(F.col("_n") >= min_count).select("_h1"))
    suspects = passing(hashed, "_h1", key_filter(candidates, "_h1"))
    return (suspects.groupBy("_h1", "_h2", *cols).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") >= min_count).drop("_h1", "_h2"))


def code_list_violations(df: DataFrame, column: str, codes: DataFrame,
                         code_col: str = "code") -> DataFrame:
    """Values of ``column`` that are not in the code list, with their row
    counts: ``(value, rows)``.

    A NULL value is no code and no violation: it is left out (missing values
    are counted by the fill rates).  NULL codes are ignored.  The count is
    pre-aggregated per value before it meets the code list."""
    per_value = (df.where(_c(column).isNotNull()).groupBy(_c(column).alias("value"))
                 .agg(F.count(F.lit(1)).alias("rows")))
    known = codes.select(_c(code_col).alias("_code")).distinct()
    return per_value.join(known, F.col("value") == F.col("_code"), "left_anti")


def code_lists_violations(df: DataFrame, lists: dict[str, str], codes: DataFrame,
                          list_col: str = "list_name", code_col: str = "code") -> DataFrame:
    """Several columns against parsed code lists in one scan: ``lists`` maps a
    column to its list name, ``codes`` holds ``(list_name, code)`` rows as the
    dictionary parser returns them.  Returns ``(column, list_name, value,
    rows)``; NULL values are left out as in ``code_list_violations``; a column
    whose list is missing has all its values returned."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(name).alias("list_name"),
                                                   _c(c).cast("string").alias("value"))
                                          for c, name in lists.items()])).alias("p")).select("p.*")
    counted = (pairs.where(F.col("value").isNotNull()).groupBy("column", "list_name", "value")
               .agg(F.count(F.lit(1)).alias("rows")))
    known = codes.select(_c(list_col).alias("list_name"), _c(code_col).cast("string").alias("value")).distinct()
    return counted.join(known, ["list_name", "value"], "left_anti").select("column", "list_name", "value", "rows")


#: Slots of the counters that rule keys out in ``top_keys``.
COUNTER_SLOTS = 1 << 18


def top_keys(df: DataFrame, key: str, k: int, slots: int = COUNTER_SLOTS, first_slots: int = 64) -> DataFrame:
    """``(key, rows)`` of the ``k`` most frequent values of ``key`` (NULL is one),
    ties by key (NULL last): exactly the first rows of the full ranking, without
    shuffling a count for every key.

    1. Rows are counted by hash slot: mergeable counters of fixed size, one scan.
       A slot's count bounds the counts of its keys.
    2. The keys of the fullest ``first_slots + 4 k`` slots are counted exactly; the
       k-th largest of these counts is a floor for the answer.
    3. Keys of the other slots that reach the floor are counted as well.  Usually
       there are none; where counts are so even that every slot reaches it, this
       is the full count (the fallback: the guarantee separates nothing).

    Slots that come to the driver: at most ``first_slots + 4 k`` numbers; those of
    step 3 stay a table."""
    value = df.select(_c(key).alias("key"), F.pmod(F.xxhash64(comparable(_c(key), df.schema[key].dataType)),
                                                   F.lit(slots)).alias("_slot"))
    counters = value.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    full = [r["_slot"] for r in counters.orderBy(F.desc("_n"), "_slot").limit(first_slots + 4 * k).collect()]
    order = [F.desc("rows"), F.asc_nulls_last("key")]

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))

    sure = counted(value.where(F.col("_slot").isin(full))).orderBy(*order).limit(k).checkpoint()
    held = sure.agg(F.count(F.lit(1)), F.min("rows")).first()
    floor = held[1] if held[0] == k else 0
    rest = counters.where((F.col("_n") >= floor) & ~F.col("_slot").isin(full)).select("_slot")
    if rest.isEmpty():
        return sure.orderBy(*order)
    more = counted(value.join(rest, "_slot", "left_semi")).where(F.col("rows") >= floor)
    return sure.unionByName(more).orderBy(*order).limit(k)
