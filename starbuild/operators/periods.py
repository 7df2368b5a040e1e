"""Covered periods: which days a table really covers, gaps left out.

A row covers one day, or the days from a start to an end.  Covered days are kept
as bitmaps, one bit a day and one 4 KB bitmap for every 32,768 days (about 90
years), merged by Spark's bitmap aggregates: a table's cover is a handful of rows
however many rows it has, and the days that two tables share are the ``and`` of
their bitmaps.  Ranges are not unfolded into days: starts and ends are counted
per day (one small row a day after the partial aggregates), and their running
sum says which days are open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Day that has number 1; day numbers of dates are positive from year 1 on.
_FIRST = "0001-01-01"
_BITS = 32768


def _number(c):
    return F.datediff(c, F.lit(_FIRST).cast("date")).cast("long") + 1


def covered_days(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """``(bucket, bits)``: the days covered by the rows, as bitmaps.

    Without ``end`` a row covers its ``start`` day; with it the days from ``start``
    to ``end``, both included.  Rows without a start, and rows that end before
    they start, cover nothing; a range without an end covers its first day."""
    first = F.col(f"`{start}`").cast("date")
    if end is None:
        days = df.select(_number(first).alias("day")).where("day is not null").distinct()
    else:
        last = F.coalesce(F.col(f"`{end}`").cast("date"), first)
        ranges = df.select(_number(first).alias("s"), _number(last).alias("e")).where("s <= e")
        steps = ranges.select(F.explode(F.array(F.struct(F.col("s").alias("day"), F.lit(1).cast("long").alias("step")),
                                                F.struct((F.col("e") + 1).alias("day"), F.lit(-1).cast("long").alias("step"))))
                              .alias("x")).select("x.*").groupBy("day").agg(F.sum("step").alias("step"))
        # at most one row for every day of the calendar, so one task may order them
        by_day = Window.orderBy("day")
        open_ = (steps.withColumn("rows", F.sum("step").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("next", F.lead("day").over(by_day)).where("rows > 0"))
        days = open_.select(F.explode(F.sequence("day", F.col("next") - 1)).alias("day"))
    return (days.groupBy(F.bitmap_bucket_number("day").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("day")).alias("bits")))


def shared_days(a: DataFrame, b: DataFrame) -> DataFrame:
    """The days that both covers have (``(bucket, bits)`` as ``covered_days``)."""
    both = a.select("bucket", "bits").unionAll(b.select("bucket", "bits"))
    return both.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits")).where("n = 2").drop("n")


def islands(cover: DataFrame) -> DataFrame:
    """``(first_day, last_day, days)`` of every stretch of covered days without a
    gap.  Bitmaps are unfolded into their days (bounded by the calendar)."""
    places = F.sequence(F.lit(0), F.lit(_BITS - 1))
    text = F.conv(F.hex(F.substring(F.col("bits"), F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(text / F.pow(F.lit(2), F.pmod("at", F.lit(8)))), F.lit(2)) == 1
    days = (cover.select("bucket", "bits", F.explode(places).alias("at")).where(bit)
            .select(((F.col("bucket") - 1) * _BITS + F.col("at") + 1).alias("day")))
    runs = days.select("day", (F.col("day") - F.row_number().over(Window.orderBy("day"))).alias("run"))
    date = lambda c: F.date_add(F.lit(_FIRST).cast("date"), (c - 1).cast("int"))
    return runs.groupBy("run").agg(date(F.min("day")).alias("first_day"), date(F.max("day")).alias("last_day"),
                                   F.count(F.lit(1)).alias("days")).drop("run")


def overlap_days(a: DataFrame, a_start: str, b: DataFrame, b_start: str, a_end: str | None = None,
                 b_end: str | None = None) -> DataFrame:
    """One row: ``a_days b_days overlap_days``, days covered by each table and by
    both.  ``period_overlap`` compares first and last days only and counts the
    gaps of either side as covered; this one does not."""
    left, right = covered_days(a, a_start, a_end), covered_days(b, b_start, b_end)
    sides = [("a", left), ("b", right), ("overlap", shared_days(left, right))]
    out = None
    for name, cover in sides:
        part = cover.select(F.lit(name).alias("side"), F.bitmap_count("bits").alias("n"))
        out = part if out is None else out.unionAll(part)
    return out.agg(*[F.coalesce(F.sum(F.when(F.col("side") == name, F.col("n"))), F.lit(0).cast("long")).alias(f"{name}_days")
                     for name, _ in sides])
