"""Consecutive ids in a total order, without a single-partition window.

``row_number() over (order by k)`` moves every row into one task.  Here
the rows are range-partitioned on the order keys and sorted inside each
partition; ``monotonically_increasing_id`` then encodes (partition,
position).  A per-partition row count — one row per partition, so its
size is bounded by the partition count, not by the data — gives each
partition its starting offset.  The id of a row is therefore its rank in
the global order, whatever the range bounds turned out to be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def single_materialization(df: DataFrame) -> DataFrame:
    """Fix the rows and partitions of ``df`` for all its consumers.

    A range exchange samples its bounds per execution, and two consumers that
    read different columns do not share it.  A reliable checkpoint in the
    shared ``spark.checkpoint.dir`` fixes the partitions once.
    """
    return df.checkpoint(eager=True)


def with_sequence_id(df: DataFrame, order_by: Sequence[str | Column], name: str,
                     start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = ``start`` + rank of the row in ``order_by`` order.

    ``order_by`` must be a total order over the rows (e.g. the columns of a
    de-duplicated frame) for the ids to be deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    ranged = single_materialization(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.select(*[F.col(f"`{c}`") for c in df.columns],
                           F.shiftright("_mid", _POS_BITS).alias("_pid"),
                           F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running sum over it is bounded by ``n``.
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long").alias(name)))
