"""SimHash groups against brute force over all pairs."""
import numpy as np
import pytest

from starbuild.llm import simhash
from starbuild.llm.components import components
from tests_llm_helpers import slow_fingerprint, slow_groups


def test_whole_table(spark, sf_dir):
    from starbuild.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    want = {i: (f"{f:016x}", g) for (i, f), g in zip(prints, slow_groups(prints, 3))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash_vptree"](spark, sf_dir).collect()}
    assert got == want
    assert len({g for _, g in want.values()}) < len(want)


@pytest.mark.parametrize("shard_points,block_rows", [(40, 1 << 16), (40, 64), (10_000, 100)])
def test_shards_lose_no_link(spark, monkeypatch, shard_points, block_rows):
    monkeypatch.setattr(simhash, "SHARD_POINTS", shard_points)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(simhash, "LEAF_POINTS", 8)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.int64)
    points = set(base.tolist())
    for b in base[:60].tolist():                       # chains of near points
        for _ in range(6):
            b ^= sum(1 << int(x) for x in rng.choice(62, rng.integers(1, 5), replace=False))
            points.add(b)
    points = sorted(points)
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    roots = {r.node: r.root for r in components(simhash.link_forest(df, len(points), 3)).collect()}
    want = slow_groups([(p, p & (1 << 64) - 1) for p in points], 3)
    groups = {}
    for p, w in zip(points, want):
        groups.setdefault(w, set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_trouble(spark, trouble, clashing, make_docs):
    for docs in (trouble, clashing):
        got = simhash.near_duplicates(docs).collect()
        assert len(got) == 10
        by = {r.id: r for r in got if r.id is not None}
        assert by[1].fp == by[2].fp == by[3].fp == 0
        assert by[1].component_id == by[2].component_id == by[3].component_id == 1
        assert [r.component_id for r in got if r.id is None or r.id == 5] == [5, 5, 5]
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(100)]
    rows = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (7, 6)], "a long, b long")
    roots = {r.node: r.root for r in components(rows).collect()}
    assert len(roots) == 201 + 101
    assert len({roots[i] for i in range(201)}) == 1
    assert len({roots[1000 + i] for i in range(101)}) == 1
    assert roots[0] != roots[1000]
    assert components(rows.where("false")).collect() == []
