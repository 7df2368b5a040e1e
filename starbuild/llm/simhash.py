"""SimHash near-duplicates found with vantage-point trees.

1. Every whole text gets a 64-bit fingerprint: a bit is 1 if it is set in
   over half of the XXH64 hashes of the word shingles, repeats included.
   Equal fingerprints are one point from here on.
2. A vantage-point tree over a bounded sample of the points (at most
   ``MAX_SAMPLE``, only its vantage points and radii are kept) splits the
   Hamming space into shards: the points within a vantage point's radius and
   the rest.  Every point belongs to one shard; by the triangle inequality a
   point can only have a neighbour on the other side of a sphere if its own
   distance is within the link distance of the radius, and only such points
   also visit the other side.  A pair split by a sphere is found on its inner
   side, so only outer points visit inward; a visitor follows every branch
   that the triangle bound leaves open.
3. In each shard (large ones in blocks of the visitors) a local tree over the
   shard's points is searched with the same bound for exact pairs.  A block
   returns a spanning forest of the links that it found, at most one link per
   point, so a dense group of n points never becomes n^2 rows.
4. Connected components of these links give the groups.

Edge cases: a null text counts as empty; a text without a word has fingerprint
zero and links like any other; a text with fewer words than a shingle is one
shingle; copies share a point; a group's id is the smallest non-null id in it
(null if no row of it has an id); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from starbuild.llm.common import checkpointed, heavy_keys, spread_join, text_or_empty, written
from starbuild.llm.components import components

SEED = 42
#: Points that a shard should hold, sample points a shard is planned from, and the sample's bound.
#: Every level of shards makes points visit more of them, so shards are large.
SHARD_POINTS, SHARD_SAMPLE, MAX_SAMPLE = 1 << 18, 64, 1 << 21
#: Fewer points are dealt finer, to at most so many shards, so that there is work for all cores.
FINE_POINTS, FINE_SHARDS = 8192, 64
#: Rows (own points and visitors) that one block of a shard searches for.
BLOCK_ROWS = 1 << 16
LEAF_POINTS = 256
PIECE = 1 << 16


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    """Fingerprint of a whole text as a signed 64-bit integer."""
    words = text.encode("utf-8", "replace").lower().split()      # bytes: ASCII white space and A-Z only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    hash64, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, PIECE):
        part = words[at:at + PIECE + k - 1]
        h = np.fromiter((hash64(join(s), SEED) for s in zip(*(part[i:] for i in range(k)))), np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(documents: DataFrame, words_per_shingle: int = 3,
                 id_col: str = "doc_id", text_col: str = "text", text_hash: bool = False) -> DataFrame:
    """``(id, fp)`` of every row, with ``text_hash`` also XXH64 of its text."""
    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, words_per_shingle)).astype("int64")

    hashed = [F.xxhash64(text_or_empty(text_col)).alias("text_hash")] if text_hash else []
    return documents.select(F.col(id_col).alias("id"), of(text_or_empty(text_col)).alias("fp"), *hashed)


@dataclass
class Node:
    """A sphere of the tree, or a shard if ``vantage`` is None."""

    shard: int = -1
    blocks: int = 1
    vantage: np.uint64 | None = None
    radius: int = 0
    inner: Node | None = None
    outer: Node | None = None


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _sphere(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve the points with the fewest of them
    near the sphere; None if no sphere splits them."""
    best = None
    for v in rng.choice(points, min(8, len(points)), replace=False):
        d = _distance(points, v).astype(np.int64)
        radius = int(np.median(d))
        if radius >= d.max():
            radius = int(d.max()) - 1
        inside = int((d <= radius).sum())
        if radius < 0 or not inside or inside == len(points):
            continue
        near = int((np.abs(d - radius) <= 3).sum()) + abs(len(points) - 2 * inside) // 2
        if best is None or near < best[0]:
            best = near, v, radius
    return None if best is None else (best[1], best[2])


def plan_shards(sample: np.ndarray, leaf_sample: int, seed: int = 17) -> Node:
    """Tree over the sample; its leaves are the shards, numbered from 0."""
    rng, count = np.random.default_rng(seed), 0

    def grow(points: np.ndarray) -> Node:
        nonlocal count
        sphere = _sphere(points, rng) if len(points) > leaf_sample else None
        if sphere is None:
            count += 1
            return Node(shard=count - 1)
        near = _distance(points, sphere[0]) <= sphere[1]
        return Node(vantage=sphere[0], radius=sphere[1], inner=grow(points[near]), outer=grow(points[~near]))

    return grow(np.unique(sample))


def route(root: Node, points: np.ndarray, reach: int) -> Iterator[tuple[Node, np.ndarray, np.ndarray]]:
    """(shard, its own points, visitors) for all shards that get any."""
    todo = [(root, points, points[:0])]
    while todo:
        node, own, guests = todo.pop()
        if not len(own) and not len(guests):
            continue
        if node.vantage is None:
            yield node, own, guests
            continue
        d, g = _distance(own, node.vantage).astype(int), _distance(guests, node.vantage).astype(int)
        r = node.radius
        todo.append((node.inner, own[d <= r], np.concatenate([guests[g <= r + reach], own[(d > r) & (d <= r + reach)]])))
        todo.append((node.outer, own[d > r], guests[g > r - reach]))


class _Groups:
    """Union-find over positions, joined by whole arrays of pairs."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            s = self.up[r]
            if np.array_equal(r, s):
                return r
            r = s

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def forest(own: np.ndarray, queries: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a spanning forest of them) between ``queries`` and the points
    ``own`` at ``reach`` or fewer bits, searched with a vantage-point tree."""
    points, at = np.unique(np.concatenate([own, queries]), return_inverse=True)
    groups, rng = _Groups(len(points)), np.random.default_rng(23)
    todo = [(own, at[:len(own)], queries, at[len(own):])]
    while todo:
        o, oi, q, qi = todo.pop()
        if not len(o) or not len(q):
            continue
        sphere = _sphere(o, rng) if len(o) > LEAF_POINTS else None
        if sphere is None:
            for i in range(0, len(q), 1024):
                hit = np.bitwise_count(q[i:i + 1024, None] ^ o[None, :]) <= reach
                x, y = np.nonzero(hit)
                groups.join(qi[i:i + 1024][x], oi[y])
            continue
        d, g = _distance(o, sphere[0]).astype(int), _distance(q, sphere[0]).astype(int)
        r = sphere[1]
        todo.append((o[d <= r], oi[d <= r], q[g <= r + reach], qi[g <= r + reach]))
        todo.append((o[d > r], oi[d > r], q[g > r - reach], qi[g > r - reach]))
    root = groups.roots(np.arange(len(points)))
    moved = root != np.arange(len(points))
    return points[moved], points[root[moved]]


def link_forest(points: DataFrame, n: int, reach: int) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of ``points``
    (distinct 64-bit ``fp``, ``n`` of them) at ``reach`` or fewer bits."""
    spark = points.sparkSession
    shards = max(1, -(-n // SHARD_POINTS), min(FINE_SHARDS, -(-n // FINE_POINTS)))
    wanted = min(MAX_SAMPLE, SHARD_SAMPLE * shards)
    share = min(1.0, wanted / max(1, n))
    # about `wanted` points: the choice is by hash, so it is the same in every run
    rows = points.where(F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = np.array([r.fp for r in rows.select("fp").toLocalIterator()], np.int64).view(np.uint64)
    root = plan_shards(sample, max(16, len(sample) // shards)) if len(sample) else Node(shard=0)
    scale = n / max(1, len(sample))
    for node, own, guests in route(root, sample, reach):
        # every block gets the own points: blocks are no smaller than these
        node.blocks = max(1, int((len(own) + len(guests)) * scale) // max(BLOCK_ROWS, int(len(own) * scale)))
    tree = spark.sparkContext.broadcast(root)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = batch["fp"].to_numpy().view(np.uint64)
            for node, own, guests in route(tree.value, p, reach):
                # own points are needed in every block of the shard; every row is a query in one block
                both = np.concatenate([own, guests])
                block = both % np.uint64(node.blocks)
                yield pd.DataFrame({"shard": node.shard, "block": block.astype(np.int32),
                                    "fp": both.view(np.int64), "query": True,
                                    "own": np.arange(len(both)) < len(own)})
                for b in range(node.blocks if node.blocks > 1 else 0):
                    rest = own[own % np.uint64(node.blocks) != b]
                    yield pd.DataFrame({"shard": node.shard, "block": np.int32(b), "fp": rest.view(np.int64),
                                        "query": False, "own": True})

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        p = rows["fp"].to_numpy().view(np.uint64)
        a, b = forest(p[rows["own"].to_numpy()], p[rows["query"].to_numpy()], reach)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = points.select("fp").mapInPandas(spread, "shard int, block int, fp long, query boolean, own boolean")
    return dealt.groupBy("shard", "block").applyInPandas(search, "a long, b long")


def near_duplicates(documents: DataFrame, words_per_shingle: int = 3, reach: int = 3,
                    id_col: str = "doc_id", text_col: str = "text", text_hash: bool = False) -> DataFrame:
    """``(id, fp, root, component_id)`` of every row (and its ``text_hash``, if
    wanted): documents whose fingerprints differ in at most ``reach`` bits are
    linked, ``root`` is one fingerprint of the component, and a component's id
    is its smallest document id."""
    prints = written(fingerprints(documents, words_per_shingle, id_col, text_col, text_hash), "simhash")
    points = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    size = points.agg(F.count("*"), F.sum("n")).first()
    groups = components(link_forest(points, size[0], reach))
    named = checkpointed(points.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = checkpointed(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")))
    named = spread_join(named.select("fp", "root"), least.drop("n"), "root",
                        heavy_keys(least, "root", "n", size[0])).select("fp", "root", "component_id")
    return spread_join(prints, named, "fp", heavy_keys(points, "fp", "n", size[1] or 0))
