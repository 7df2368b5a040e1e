"""Key-repair joins: a prefix stripped before matching, and lookups that
fill missing attributes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.functions.casts import safe_cast


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns whose types Spark can hash (a map, at any depth, it cannot)."""
    return [f.name for f in df.schema.fields if not re.search(r"\b(map|variant)\b", f.dataType.simpleString())]


def key_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a join key, the same on both sides of a join."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


#: Left rows of a hot key that one task takes, and rows that all salts together
#: may add to the right side (a row per hot key and salt).
ROWS_PER_TASK = 1_000_000
MAX_SALTED_ROWS = 1 << 16


def salt_widths(hot: Mapping[int, int] | Sequence[int], partitions: int, buckets: int | None = None) -> dict[int, int]:
    """``{key hash: salts}`` of the hot keys, in powers of two.

    With row counts a key gets a salt for every ``ROWS_PER_TASK`` of its rows
    (two at least, ``partitions`` at most), without them ``buckets`` (default:
    ``partitions``).  All salts together stay within ``MAX_SALTED_ROWS``: the
    widest are halved until they do."""
    if 2 * len(hot) > MAX_SALTED_ROWS:
        raise ValueError(f"at most {MAX_SALTED_ROWS // 2} hot keys can be salted, not {len(hot)}")
    rows = hot if isinstance(hot, Mapping) else {}
    out = {}
    for h in hot:
        width = buckets or (-(-rows[h] // ROWS_PER_TASK) if h in rows else partitions)
        out[h] = 1 << (max(2, min(width, partitions)) - 1).bit_length()
    while sum(out.values()) > MAX_SALTED_ROWS:
        widest = max(out.values())
        out = {h: w // 2 if w == widest else w for h, w in out.items()}
    return out


def salted_left_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]],
                     salt_by: Sequence[str], hot: Mapping[int, int] | Sequence[int] = (),
                     buckets: int | None = None, how: str = "left") -> DataFrame:
    """``left JOIN right ON left.a = right.b AND ...`` without sending all left
    rows of a hot or NULL key to one partition.

    Left rows with a NULL key cannot match; left rows whose key hash is in
    ``hot`` (values of ``key_hash``, best with their row counts as
    ``hot_of_counts`` returns them) are too many for one task.  Both get a salt
    from a hash of ``salt_by``, the right rows of hot keys are repeated for
    every salt of their key (see ``salt_widths``; at most ``MAX_SALTED_ROWS`` a
    row of one key each, whatever the partition count), and all other rows have
    salt 0.  The salt only decides where rows meet: the result and the accepted
    inputs are those of a plain join, whichever join Spark picks from the sides'
    bytes.  ``right`` must not have columns named like ``left``'s; two keys of
    one hash are both salted.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_width: dict[int, list[int]] = {}
    for h, width in salt_widths(hot, partitions, buckets).items():
        by_width.setdefault(width, []).append(h)

    def width_of(key: Column) -> Column:
        """Salts of a hot key, NULL for the others (one set lookup a width)."""
        out = F.lit(None).cast("long")
        for width, hashes in by_width.items():
            out = F.when(key.isin(hashes), F.lit(width).cast("long")).otherwise(out)
        return out

    any_null = F.lit(False)
    for a, _ in keys:
        any_null = any_null | F.col(f"`{a}`").isNull()
    width = F.when(any_null, F.lit(buckets or partitions).cast("long")).otherwise(width_of(key_hash([a for a, _ in keys])))
    salt = F.pmod(key_hash(list(salt_by)), width) + 1
    lf = left.withColumn("_lsalt", F.when(width.isNotNull(), salt).otherwise(F.lit(0).cast("long")))
    # A constant 0 (even ``hash * 0``, which the optimizer simplifies) would
    # be folded into a non-equi join condition, leaving the salt out of the
    # shuffle keys.  ``least(bit_count(hash), 0)`` is always 0 (a bit count
    # is never negative) but opaque to the optimizer.
    h = key_hash([b for _, b in keys])
    zero = F.least(F.bit_count(h), F.lit(0)).cast("long")
    if by_width:
        many = F.sequence(F.lit(1).cast("long"), width_of(h))
        zero = F.explode(F.when(width_of(h).isNotNull(), many).otherwise(F.array(zero)))
    rt = right.withColumn("_rsalt", zero)
    cond = [F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in keys]
    cond.append(F.col("_lsalt") == F.col("_rsalt"))
    return lf.join(rt, cond, how).drop("_lsalt", "_rsalt")


def hot_keys(df: DataFrame, columns: Sequence[str], share: float = 0.001, least: int = 100_000) -> dict[int, int]:
    """``{hash: rows}`` of the keys that hold more than ``share`` of all rows (and
    more than ``least``): at most ``1 / share`` of them, whatever the data."""
    counts = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return hot_of_counts(counts, columns, "_n", share, least)


def hot_of_counts(counts: DataFrame, columns: Sequence[str], n: str, share: float = 0.001,
                  least: int = 100_000) -> dict[int, int]:
    """``hot_keys`` from a table that already counts the rows of every key.
    Counts of at most ``least`` rows never need spreading, so the total is
    asked for only if one is larger."""
    large = [(r[0], r[1]) for r in counts.where(F.col(n) > least)
             .select(key_hash(list(columns)), n).orderBy(F.col(n).desc()).limit(int(1 / share)).collect()]
    if not large:
        return {}
    total = counts.agg(F.sum(n)).first()[0]
    return {h: m for h, m in large if m > share * total}


def prefix_key_join(left: DataFrame, left_col: str, right: DataFrame, right_col: str,
                    prefix: str, key_type: str | None = None, how: str = "inner",
                    hot: Mapping[int, int] | Sequence[int] = ()) -> DataFrame:
    """Join ``left[left_col]`` to ``right[right_col]`` with ``prefix``
    removed from the start of the right-hand value (e.g. ``US-CA`` -> ``CA``),
    optionally cast to ``key_type``.

    Right rows whose key does not parse get a NULL key and match nothing.  Two
    right values may have the same key without the prefix (``US-CA`` and
    ``CA``): the row with the smallest ``right_col`` stands for the key, so a
    left row never appears twice.  Left rows of NULL keys and of the ``hot``
    keys (see ``hot_keys``) are spread over many tasks."""
    key = F.regexp_replace(F.col(f"`{right_col}`"), "^" + re.escape(prefix), "")
    if key_type is not None:
        key = safe_cast(key, key_type)
    row = F.struct(*[F.col(f"`{c}`") for c in right.columns])
    r = (right.select(key.alias("_rk"), F.col(f"`{right_col}`").alias("_order"), row.alias("_row"))
         .where(F.col("_rk").isNotNull()).groupBy("_rk").agg(F.min_by("_row", "_order").alias("_row"))
         .select("_rk", "_row.*"))
    salt_by = hashable_columns(left)
    return salted_left_join(left, r, [(left_col, "_rk")], salt_by, hot, how=how).drop("_rk")


def fill_from_lookup(df: DataFrame, target: str, key: str, lookup: DataFrame,
                     lookup_key: str, lookup_value: str, salt_by: Sequence[str] | None = None,
                     hot: Mapping[int, int] | Sequence[int] = ()) -> DataFrame:
    """Fill NULLs of ``target`` with ``lookup_value`` of the lookup row whose
    ``lookup_key`` equals ``df[key]``; present values are kept.

    The lookup is reduced to one value per key first (the smallest, so the
    result is deterministic), which also guarantees the left join cannot
    duplicate rows; rows with a NULL key, or one of the ``hot`` keys, are
    spread by a salt from ``salt_by`` (default: every column that can be
    hashed) rather than shuffled to one partition (``salted_left_join``).
    """
    lk = (lookup.groupBy(F.col(f"`{lookup_key}`").alias("_lk"))
          .agg(F.min(F.col(f"`{lookup_value}`")).alias("_lv")))
    joined = salted_left_join(df, lk, [(key, "_lk")], salt_by or hashable_columns(df), hot)
    return joined.select(*[F.coalesce(F.col(f"`{c}`"), F.col("_lv")).alias(c) if c == target
                           else F.col(f"`{c}`") for c in df.columns])
