"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

1. Equal vectors of one label are one point (with its number of rows).
2. Spherical k-means, fitted on at most ``MAX_SAMPLE`` points and
   ``MAX_SAMPLE_BYTES`` of them, assigns every point to the cell of its nearest
   centroid.
3. No link across a cell border is lost: a point also visits each cell of a
   higher number whose border (the bisecting plane of two centroids) is
   within the link angle of it, ``x.(c - c') <= sin(angle) |c - c'|``; a
   partner on the other side of a border cannot be farther from it than that.
   The partner's cell has borders with all centroids, so the same must hold for
   the ``NEAREST`` centroids of the point in place of its own.
   A visitor is compared only with the cell's own points.
4. The rows of a (label, cell) group are dealt into a grid of blocks; a task
   multiplies two blocks in double precision.  It returns the number of links
   per point and a spanning forest of the links, never the pairs themselves.
5. Connected components of the forests give the groups; the row with the
   smallest id of each is kept.

Vectors are compared only within one label and one length.  Edge cases: a row
whose label or vector is null, or whose vector is empty, zero or has a null or
non-finite component, links with nothing and is its own group; a null id is
never kept; copies link with each other; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import checkpointed, heavy_keys, spread_join, written
from starbuild.llm.components import components
from starbuild.llm.simhash import _Groups

#: Points of one label that a cell should hold, sample points per cell, and the sample's bound.
CELL_POINTS, CELL_SAMPLE, MAX_SAMPLE = 2000, 24, 1 << 16
#: Bound of the sample in double precision, in the driver.
MAX_SAMPLE_BYTES = 128 << 20
#: Centroids near a point whose borders with a cell are tested.
NEAREST = 16
BLOCK, TILE = 4096, 1024


def _unit(rows) -> np.ndarray:
    """Rows scaled to length 1 in double precision (first by their largest
    component, so that squares neither overflow nor vanish)."""
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Spherical k-means of unit rows; at most ``k`` centroids."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def _distances(c: np.ndarray) -> np.ndarray:
    """Distances of all pairs of at most 2,731 centroids, never too small: the
    added 1e-7 exceeds the rounding of the products."""
    square = (c * c).sum(1)
    return np.sqrt(np.maximum(square[:, None] + square - 2 * (c @ c.T), 0)) + 1e-7


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"v": [np.asarray(e, np.float64).tobytes() for e in batch["e"]]})


def _sample(points: DataFrame, share: float) -> dict[int, list[np.ndarray]]:
    """Vectors by length: about ``share`` of the points by their hash, as bytes,
    until ``MAX_SAMPLE_BYTES`` are there."""
    rows = points.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("e").mapInPandas(_packed, "v binary")
    found, size = [], 0
    for r in rows.toLocalIterator():
        size += len(r.v)
        if found and size > MAX_SAMPLE_BYTES:
            break
        found.append(bytes(r.v))
    by_length: dict[int, list[np.ndarray]] = {}
    for v in sorted(found):
        by_length.setdefault(len(v) // 8, []).append(np.frombuffer(v))
    return by_length


def _assign(points: DataFrame, centroids: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """``(rid, g, e, n, own)``: every point in its own cell and as a visitor."""
    shared = points.sparkSession.sparkContext.broadcast(centroids)
    reach = float(np.sqrt(1 - cosine * cosine)) + 1e-9

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, rows in batch.groupby(batch["e"].map(len)):
                rows = rows.reset_index(drop=True)
                c = shared.value.get(length)
                if c is None:                          # a length that the sample lacks is one cell
                    yield rows.assign(cell=0, own=True)
                    continue
                if length not in between:
                    between[length] = _distances(c)
                apart = between[length]
                sims = _unit(rows["e"]) @ c.T
                home = sims.argmax(1)
                nearest = np.argpartition(-sims, min(NEAREST, len(c)) - 1, axis=1)[:, :NEAREST]
                yield rows.assign(cell=home.astype(np.int32), own=True)
                for h in np.unique(home):
                    at = np.flatnonzero(home == h)
                    visit = (sims[at, h][:, None] - sims[at] <= reach * apart[h]) & (np.arange(len(c)) > h)
                    i, cell = np.nonzero(visit)
                    for other in nearest[at].T:
                        inside = sims[at[i], other[i]] - sims[at[i], cell] <= reach * apart[other[i], cell]
                        i, cell = i[inside], cell[inside]
                    if len(i):
                        yield rows.iloc[at[i]].assign(cell=cell.astype(np.int32), own=False)

    dealt = points.select("rid", "label", "e", "n").mapInPandas(
        lambda it: (x[["rid", "label", "e", "n", "cell", "own"]] for x in deal(it)),
        "rid long, label string, e array<double>, n long, cell int, own boolean")
    return dealt.select("rid", "e", "n", "own", F.xxhash64("label", F.size("e"), "cell").alias("g"),
                        F.struct("label", F.size("e").alias("length"), "cell").alias("group"))


def _compare(cosine: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        own, query = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if own.empty or query.empty:
            return pd.DataFrame({"kind": [], "a": [], "b": []})
        x, y = _unit(own["e"]), _unit(query["e"])
        xi, yi, xn, yn = (f[c].to_numpy() for f, c in ((own, "rid"), (query, "rid"), (own, "n"), (query, "n")))
        guest = ~query["own"].to_numpy()
        ids, at = np.unique(np.concatenate([xi, yi]), return_inverse=True)
        xa, ya = at[:len(xi)], at[len(xi):]
        links, groups = np.zeros(len(ids), np.int64), _Groups(len(ids))
        for i in range(0, len(x), TILE):
            for j in range(0, len(y), TILE):
                p, q = np.nonzero(x[i:i + TILE] @ y[j:j + TILE].T >= cosine)
                p, q = p + i, q + j
                p, q = p[xi[p] != yi[q]], q[xi[p] != yi[q]]
                np.add.at(links, xa[p], yn[q])
                # both points of an own pair are met as query in some block; a visitor only here
                np.add.at(links, ya[q[guest[q]]], xn[p[guest[q]]])
                groups.join(xa[p], ya[q])
        root = groups.roots(np.arange(len(ids)))
        moved = root != np.arange(len(ids))
        some = links > 0
        return pd.concat([pd.DataFrame({"kind": 0, "a": ids[some], "b": links[some]}),
                          pd.DataFrame({"kind": 1, "a": ids[moved], "b": ids[root[moved]]})])
    return compare


def near_duplicates(embeddings: DataFrame, cosine: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row."""
    # adding 0 turns -0.0 into 0.0, so that equal vectors have equal bytes
    vector = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v + F.lit(0.0))
    good = (F.col("label").isNotNull() & F.col("e").isNotNull()
            & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            & F.exists("e", lambda v: v != 0))
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), vector.alias("e"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    valid = rows.where("good").select("id", "label", "e", F.xxhash64("label", "e").alias("h"))
    points = (valid.groupBy("h", "label", "e").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .withColumn("rid", F.monotonically_increasing_id()))
    points = written(points, "vectors")                # fixes rid
    labels = points.groupBy("label").agg(F.count("*").alias("points"), F.sum("n").alias("n"),
                                         F.sum(F.size("e") * F.lit(8).cast("long")).alias("bytes"))
    count, total, largest, size = labels.agg(*[F.coalesce(f(c), F.lit(0)) for f, c in (
        (F.sum, "points"), (F.sum, "n"), (F.max, "points"), (F.sum, "bytes"))]).first()

    # only points of one label meet: as many cells as the largest label needs
    most = min(MAX_SAMPLE, int(0.9 * MAX_SAMPLE_BYTES * count / max(1, size)))
    k = max(1, min(-(-largest // CELL_POINTS), most // CELL_SAMPLE))
    share = min(1.0, min(max(CELL_SAMPLE * k, 1000), max(1, most)) / max(1, count))
    by_length = _sample(points, share)
    sampled = sum(map(len, by_length.values()))
    centroids = {length: fit_centroids(_unit(es), max(1, k * len(es) // sampled)) for length, es in by_length.items()}

    dealt = written(_assign(points, centroids, cosine), "cells")
    sizes = checkpointed(dealt.groupBy("g").agg(F.count_if("own").alias("own_rows"), F.count("*").alias("all_rows"))
                         .withColumn("own_blocks", F.ceil(F.col("own_rows") / BLOCK).cast("int"))
                         .withColumn("query_blocks", F.ceil(F.col("all_rows") / BLOCK).cast("int")))
    heavy = heavy_keys(sizes, "g", "all_rows", dealt.count())
    placed = spread_join(dealt, sizes.where("own_rows > 0"), "g", heavy, "inner")
    last = F.lit(-1)
    mine = F.pmod(F.xxhash64("rid"), F.col("own_blocks")).cast("int")
    asked = F.pmod(F.xxhash64("rid"), F.col("query_blocks")).cast("int")
    grid = (placed.where("own").withColumn("side", F.lit(0)).withColumn("ob", mine)
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") + last)))
            .unionByName(placed.withColumn("side", F.lit(1)).withColumn("qb", asked)
                         .withColumn("ob", F.explode(F.sequence(F.lit(0), F.col("own_blocks") + last)))))
    found = (grid.select("group", "ob", "qb", "rid", "e", "n", "own", "side").groupBy("group", "ob", "qb")
             .applyInPandas(_compare(cosine), "kind int, a long, b long"))
    found = written(found, "links")

    links = found.where("kind = 0").groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("links"))
    groups = components(found.where("kind = 1").select("a", "b")).withColumnRenamed("node", "rid")
    named = checkpointed(points.select("rid", "h", "label", "e", "first", "n").join(links, "rid", "left")
                         .join(groups, "rid", "left")
                         .withColumn("root", F.coalesce("root", "rid"))
                         .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1))
    least = checkpointed(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("points")))
    named = spread_join(named, least, "root", heavy_keys(least, "root", "points", count))
    right = named.select("h", F.col("label").alias("label2"), F.col("e").alias("e2"), "n_links", "component_id")
    joined = (spread_join(valid, right, "h", heavy_keys(points, "h", "n", total), "inner")
              .where("label = label2 and e = e2").select("id", "n_links", "component_id"))
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
