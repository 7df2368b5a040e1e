"""Connected components of a link table, by contraction.

In every round each node points at the neighbour (or itself) that comes first
in a pseudorandom order of that round; links are rewritten to these targets,
loops and repeats go, and the rest is the next round's smaller graph.  The
order changes with the round, so long chains shrink by a constant factor too.
Every round is cut by a reliable checkpoint; nothing but row counts and fewer
than 2,000 heavy nodes comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import checkpointed, heavy_keys, spread_join


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node that occurs in ``links`` (64-bit ids);
    two nodes have the same root exactly if links connect them.  Null ends
    and loops are ignored; an empty link table gives an empty result."""
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    edges = checkpointed(edges)
    labels = None
    turn = 0
    while (n := edges.count()) or labels is None:
        def order(col: str, turn: int = turn):
            return F.struct(F.xxhash64(F.col(col), F.lit(turn)).alias("h"), F.col(col).alias("v"))

        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        targets = checkpointed(both.groupBy("a").agg(F.min(order("b")).alias("m"), F.count("*").alias("n"))
                               .select(F.col("a").alias("node"), F.least("m", order("a"))["v"].alias("root"), "n"))
        heavy = heavy_keys(targets, "node", "n", n)
        to = targets.select("node", "root")
        if labels is None:
            labels = to
        else:
            sizes = labels.groupBy("root").agg(F.count("*").alias("n"))
            step = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = (spread_join(labels, step, "root", heavy_keys(sizes, "root", "n", labels.count()))
                      .select("node", F.coalesce("next", "root").alias("root")))
        edges = spread_join(edges, to.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", heavy, "inner")
        edges = spread_join(edges, to.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", heavy, "inner")
        edges = checkpointed(edges.where("ra != rb")
                             .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        labels = checkpointed(labels)
        turn += 1
    return labels
