"""The mix against its rules, recomputed without Spark."""
import re
from collections import defaultdict

from starbuild.llm import mixing
from tests_llm_helpers import slow_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(rows, docs, tolerance):
    size, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        size[source] += len(WORD.findall(text or ""))
    target = slow_targets(dict(size))
    left = sorted(((i, len(WORD.findall(t or "")), size[s], round(target[s], 6)) for i, t, s in docs), key=str)
    assert left == sorted(((r.id, r.size, r.source_size, round(r.target, 6)) for r in rows), key=str)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[round(r.target, 6), r.source_size] += r.taken
    want = defaultdict(float)
    for s in size:
        want[round(target[s], 6), size[s]] += target[s]
    for k, t in want.items():
        assert abs(taken[k] - t) <= max(tolerance * t, 200), (k, taken[k], t)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = mixing.mix(docs).collect()
    check(got, [(r.doc_id, r.text, r.source) for r in docs.collect()], 0.05)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(got) == sorted(again)


def test_small_shards_and_capped_source(spark, make_docs):
    docs = [(i, "w " * (20 + i % 50), f"s{i % 3}") for i in range(600)] + [(1000, "tiny source here", "z"),
                                                                          (1001, "null source words " * 30, None)]
    rows = mixing.mix(make_docs(docs), shard_blocks=64, block_words=16).collect()
    check(rows, docs, 0.05)


def test_trouble(spark, trouble, clashing, make_docs):
    for docs in (trouble, clashing):
        rows = mixing.mix(docs).collect()
        assert len(rows) == 10
        assert {r.id: r.taken for r in rows if r.size == 0} == {1: 0, 2: 0, 3: 0}
        # one source: everything is taken once
        assert sum(r.taken for r in rows) == sum(r.size for r in rows)
    assert mixing.mix(make_docs([])).collect() == []
    assert [(r.taken, r.target) for r in mixing.mix(make_docs([(1, "", "a"), (2, None, None)])).collect()] == [(0, 0.0)] * 2


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F
    for n in (1, 2, 7, 64, 1000):
        keys = F.transform(F.sequence(F.lit(1), F.lit(24)), lambda r: F.pmod(F.xxhash64(r), F.lit(n)))
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), keys)).collect()]
        assert sorted(got) == list(range(n))
        assert n < 64 or got != list(range(n))
