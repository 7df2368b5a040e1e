"""Exact order statistics by repeated histograms of fixed size.

To find the value of a rank, a column's range is cut into ``BINS`` bins that
keep the order; one aggregate counts every bin and notes its smallest and
largest value.  The bin that holds the rank becomes the next range (its real
ends, so empty space costs nothing), until a range has few rows or few possible
values; then its bins are the values themselves.  Ranges shrink by up to
``BINS`` each time, so two or three scans answer for most tables, whatever
their size.

Every scan shuffles at most ``BINS`` (or ``FEW``) small rows a task, range and
column, counted in the map tasks; nothing is sorted, range-partitioned or
checkpointed, and only the bins of the wanted ranks come to the driver.  All
ranks of all columns of one type share a scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from math import inf, isinf, log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

#: Bins a range, and rows or possible values of a range that is read exactly.
BINS = 4096
FEW = 1 << 15
#: Resolution of the logarithmic bins, in doublings of the distance.
_DOUBLINGS = 52
_LARGEST = 1.7976931348623157e308


@dataclass
class Range:
    """A range of values that holds wanted ranks (counted from its first row)."""
    low: object
    high: object
    rows: int
    ranks: set[int]
    below: int = 0            # rows of the column before the range
    logarithmic: bool = False
    found: dict[int, object] = field(default_factory=dict)


def _possible(low, high, dtype) -> float:
    """How many values of the type lie in the range."""
    if isinstance(dtype, DoubleType):
        return inf
    scale = dtype.scale if isinstance(dtype, DecimalType) else 0
    return float((Decimal(high) - Decimal(low)).scaleb(scale)) + 1


def _literal(value, dtype) -> Column:
    return F.lit(format(value, "f") if isinstance(value, Decimal) else value).cast(dtype)


def _is_few(r: Range, dtype) -> bool:
    return r.rows <= FEW or _possible(r.low, r.high, dtype) <= FEW


def _position(v: Column, r: Range, dtype) -> Column:
    """Where a value lies in the range: a double from 0 (low) to 1 (high) that
    never falls while the value rises."""
    if isinstance(dtype, DoubleType):
        low, high = max(r.low, -_LARGEST), min(r.high, _LARGEST)
        if isinf(high - low):
            part = (v / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        else:
            part = (v - F.lit(low)) / F.lit(high - low)
        if r.logarithmic:
            part = F.log1p(part * F.lit(2.0 ** _DOUBLINGS)) / F.lit(log1p(2.0 ** _DOUBLINGS))
        return F.when(v == -inf, F.lit(0.0)).when(v == inf, F.lit(1.0)).otherwise(part)
    low, high = float(r.low), float(r.high)
    if high > low and (isinstance(r.low, int) or high - low > 1e-9 * max(abs(low), abs(high))):
        return (v.cast("double") - F.lit(low)) / F.lit(high - low)
    # nearly or wholly equal as doubles: the exact distance is small
    gap = float(Decimal(r.high) - Decimal(r.low))
    return (v - _literal(r.low, dtype)).cast("double") / F.lit(gap)


def _bin(v: Column, r: Range, dtype) -> Column:
    part = _position(v, r, dtype)
    # infinite ends have a bin of their own
    return F.greatest(F.lit(0), F.least(F.floor(part * BINS), F.lit(BINS - 1))).cast("int")


def _scan(df: DataFrame, dtype, ranges: Mapping[str, list[Range]]) -> None:
    """Replaces every range by the bins that hold its ranks, or finds them."""
    cells, wanted = [], []
    for i, (name, some) in enumerate(ranges.items()):
        v = F.col(f"`{name}`")
        code, exact = None, []
        for j, r in enumerate(some):
            few = _is_few(r, dtype)
            inside = (v >= _literal(r.low, dtype)) & (v <= _literal(r.high, dtype))
            at = F.struct(F.lit(j).alias("range"), (F.lit(0) if few else _bin(v, r, dtype)).alias("bin"))
            code = F.when(inside, at) if code is None else code.when(inside, at)
            if few:
                exact.append(j)
            wanted += [(i, j, rank) for rank in r.ranks]
        cells.append(F.struct(F.lit(i).alias("c"), code.alias("at"), v.alias("v"),
                              F.when(code["range"].isin(exact), v).alias("x") if exact else F.lit(None).cast(dtype).alias("x")))
    rows = df.select(F.explode(F.array(*cells)).alias("e")).where("e.at is not null")
    bins = (rows.groupBy("e.c", F.col("e.at.range").alias("range"), F.col("e.at.bin").alias("bin"), "e.x")
            .agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("low"), F.max("e.v").alias("high")))
    order = Window.partitionBy("c", "range").orderBy("bin", "x").rowsBetween(Window.unboundedPreceding, 0)
    ends = bins.withColumn("end", F.sum("n").over(order))
    ranks = df.sparkSession.createDataFrame(wanted, "c int, range int, rank long")
    hits = ends.join(F.broadcast(ranks), ["c", "range"]).where("rank >= end - n and rank < end").collect()
    names = list(ranges)
    held: dict[tuple, Range] = {}
    for h in hits:
        old = ranges[names[h.c]][h.range]
        start = h.end - h.n
        new = held.get((h.c, h.range, start))
        if new is None:
            new = held[h.c, h.range, start] = Range(h.low, h.high, h.n, set(), old.below + start)
            # a bin that kept much of the range: distances differ by orders of magnitude
            new.logarithmic = old.logarithmic != (h.n * 16 > old.rows) and isinstance(dtype, DoubleType)
        new.ranks.add(h.rank - start)
    for i, name in enumerate(names):
        ranges[name][:] = [r for (c, _, _), r in held.items() if c == i]


def values_at_ranks(df: DataFrame, dtype, wanted: Mapping[str, tuple[int, object, object, Iterable[int]]]) -> dict[tuple[str, int], object]:
    """``{(column, rank): value}`` of columns of one type: ``bigint``, a decimal
    or ``double`` (no NaN).  ``wanted`` gives each column's non-null rows, its
    smallest and largest value and the ranks (from 0) asked for."""
    ranges = {name: [Range(low, high, rows, set(ranks))] for name, (rows, low, high, ranks) in wanted.items() if rows}
    found: dict[tuple[str, int], object] = {}
    while True:
        for name in list(ranges):
            for r in [r for r in ranges[name] if r.low == r.high]:
                found.update({(name, r.below + k): r.low for k in r.ranks})
            ranges[name] = [r for r in ranges[name] if r.low != r.high]
            if not ranges[name]:
                del ranges[name]
        if not ranges:
            return found
        _scan(df.select(*[F.col(f"`{n}`") for n in ranges]), dtype, ranges)


def interpolated(found: Mapping[int, object], rows: int, p: float) -> float | None:
    """The linearly interpolated quantile from the values next to it."""
    if not rows:
        return None
    h = p * (rows - 1)
    low, high = float(found[int(h)]), float(found[_ceil(h)])
    return low if low == high else low + (high - low) * (h - int(h))


def _ceil(h: float) -> int:
    return int(h) if h == int(h) else int(h) + 1


def ranks_next_to(rows: int, probs: Iterable[float]) -> set[int]:
    """The ranks that ``interpolated`` needs."""
    return reduce(set.union, ({int(h), _ceil(h)} for h in (p * (rows - 1) for p in probs)), set()) if rows else set()
