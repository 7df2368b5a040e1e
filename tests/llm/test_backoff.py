"""Stupid backoff against a direct computation and against SQL."""
import math
import os
import re
import time
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starbuild.llm import backoff
from starbuild.llm.common import FREE_SHUFFLES
from starbuild.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_scores(rows, order=3, discount=0.4, min_count=2):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    counts = Counter(tuple(w[e - k:e]) for _, w in texts for k in range(1, order + 1) for e in range(k, len(w) + 1))
    words = sum(len(w) for _, w in texts)

    def log(gram, given_up=0):
        if len(gram) == 1:
            return math.log10(counts[gram] / words) + given_up * math.log10(discount)
        if counts[gram] >= min_count:
            return math.log10(counts[gram] / counts[gram[:-1]]) + given_up * math.log10(discount)
        return log(gram[1:], given_up + 1)

    def total(w):
        # where the text begins, the n-gram is as long as there are words; missing orders count as given up
        return sum(log(tuple(w[max(0, e - order):e]), max(0, order - e)) for e in range(1, len(w) + 1))
    return [(i, len(w), total(w)) for i, w in texts]


def test_small_and_trouble(spark, make_docs, trouble, clashing):
    rows = [(1, "a b c a b c a b d"), (2, "a b c"), (3, "x y"), (4, "c a b d x"), (4, "c a b d x")]
    for order in (1, 2, 3):
        got = sorted((r.id, r.n_words, round(r.log_score, 6)) for r in backoff.scores(make_docs(rows), order).collect())
        assert got == sorted((i, n, round(s, 6)) for i, n, s in slow_scores(rows, order))
    for docs in (trouble, clashing):
        want = slow_scores([(r.doc_id, r.text) for r in docs.collect()])
        got = sorted((str(r.id), r.n_words, round(r.log_score, 4)) for r in backoff.scores(docs).collect())
        assert got == sorted((str(i), n, round(s, 4)) for i, n, s in want)
    assert backoff.scores(make_docs([])).collect() == []


def test_salted_grams_and_documents(spark, make_docs, monkeypatch):
    """Frequent n-grams and documents that occur ten thousand times: the same
    scores, and the copies are not one task's work."""
    rows = [(i, " ".join("abcd"[(i * j * j + j) % 4] for j in range(5 + i % 9))) for i in range(60)]
    rows += [(None, "a b a b c")] * 300 + [(7, "d d d")] * 100
    want = sorted((str(i), n, round(s, 6)) for i, n, s in slow_scores(rows))
    for least in (100_000, 1):
        monkeypatch.setattr(backoff, "LEAST_HEAVY", least)
        got = backoff.scores(make_docs(rows)).collect()
        assert sorted((str(r.id), r.n_words, round(r.log_score, 6)) for r in got) == want
    monkeypatch.setattr(backoff, "COPIES", 300)
    same = make_docs([(1, "x y x")] * 10_000 + [(2, "x y")])
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(key, value)
    try:
        out = backoff.scores(same)
        assert {(r.id, r["count"]) for r in out.groupBy("id").count().collect()} == {(1, 10_000), (2, 1)}
        parts = out.select("id", F.spark_partition_id().alias("p")).where("id = 1").distinct().count()
        assert parts > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_tables_are_relations(spark, make_docs):
    """Counts of every n-gram, and weights that add up to the scores by hand."""
    docs = make_docs([(1, "a b a b"), (2, "a b c")])
    rows = docs.select(F.col("doc_id").alias("doc"), backoff.document_words(F.col("text")).alias("w"))
    counts = backoff.count_tables(rows, 3, 1)
    assert sorted((r.k, r.n) for r in counts.collect()) == [
        (1, 1), (1, 3), (1, 3), (2, 1), (2, 1), (2, 3), (3, 1), (3, 1), (3, 1)]
    model = {r.gram: r.weight for r in backoff.weights(counts, 3, 0.4).collect()}
    assert len(model) == 9
    grams = backoff.exploded_grams(rows, 3)
    assert grams.count() == 4 + 3 + 2 + 3 + 2 + 1


def test_main_path_is_relational(spark, make_docs):
    plan = backoff.scores(make_docs([(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan and "Pandas" not in plan


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf_dir}/documents.parquet'")
    got = QUERIES["op2_backoff_scores"](spark, sf_dir)
    want = con.sql(ORACLE["op2_backoff_scores"])
    assert got.columns == want.columns
    for g, w in zip(sorted(map(tuple, got.collect())), sorted(want.fetchall()), strict=True):
        assert g == pytest.approx(w)


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_passes_are_whole_and_leave_no_shuffles(spark, make_docs, monkeypatch):
    """Hash ranges share all n-grams, the number of passes changes no score, and
    the shuffle files of every pass are gone when it is written."""
    docs = make_docs([(i, " ".join("abcd"[(i * j + j * j) % 4] for j in range(i))) for i in range(12)])
    rows = docs.select(F.col("doc_id").alias("doc"), backoff.document_words(F.col("text")).alias("w"))
    for k in (1, 2, 3):
        parts = [sorted(map(tuple, backoff.grams_of_order(rows, k, 3, part).collect())) for part in range(3)]
        assert sorted(sum(parts, [])) == sorted(map(tuple, backoff.grams_of_order(rows, k).collect()))
    before = spark.conf.get(FREE_SHUFFLES), shuffle_files(spark)
    counts = backoff.count_tables(rows, 2, 1)
    for _ in range(50):
        left = shuffle_files(spark) - before[1]
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(FREE_SHUFFLES) == before[0]
    assert counts.groupBy("past", "rest").count().where("count > 1").count() == 0
    want = sorted((i, n, round(s, 6)) for i, n, s in slow_scores([(r.doc_id, r.text) for r in docs.collect()]))
    for passes in (1, 3):
        monkeypatch.setattr(backoff, "PASSES", passes)
        assert sorted((r.id, r.n_words, round(r.log_score, 6)) for r in backoff.scores(docs).collect()) == want


def test_weights_are_written_in_passes_and_as_counts(spark, make_docs, monkeypatch):
    """No pass joins all n-grams of an order, and no logarithm is written, which
    takes 64 bits for each n-gram; the passes share all n-grams."""
    docs = make_docs([(i, " ".join("abcd"[(i * j + j * j) % 4] for j in range(i))) for i in range(12)])
    rows = docs.select(F.col("doc_id").alias("doc"), backoff.document_words(F.col("text")).alias("w"))
    counts = backoff.count_tables(rows, 3, 1)
    tables, write = [], backoff.written

    def noted(df, name, **options):
        tables.append(write(df, name, **options))
        return tables[-1]
    monkeypatch.setattr(backoff, "written", noted)
    whole = backoff.weights(counts, 3, 0.4)
    sizes, passes = [t.count() for t in tables], backoff.PASSES
    assert len(sizes) == 2 * passes > 2 and {kind for t in tables for _, kind in t.dtypes} == {"bigint"}
    for k, mine in ((2, sizes[:passes]), (3, sizes[passes:])):
        n = counts.where(F.col("k") == k).count()
        assert max(mine) < n == sum(mine) == whole.where(F.col("k") == k).count()
    monkeypatch.setattr(backoff, "PASSES", 1)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, backoff.weights(counts, 3, 0.4).collect()))


def test_count_tables_go_when_the_weights_are_written(spark, make_docs, monkeypatch):
    """Behind the weights the disk holds no counts of bigrams and trigrams, which
    the weights have, too; the scores are whole."""
    rows = [(i, " ".join("abcd"[(i * j + j * j) % 4] for j in range(i))) for i in range(12)]
    folders, write = [], backoff.written

    def noted(df, name, **options):
        table = write(df, name, **options)
        folders.append((name, {file.rpartition("/")[0].removeprefix("file:").replace("//", "/") for file in table.inputFiles()}))
        return table
    monkeypatch.setattr(backoff, "written", noted)
    got = backoff.scores(make_docs(rows))
    left = [[os.path.isdir(f) for f in found] for name, found in folders if name == "grams"]
    assert len(left) > 2 and all(left[0]) and not any(sum(left[1:], []))
    assert all(os.path.isdir(f) for name, found in folders if name != "grams" for f in found)
    assert sorted((r.id, r.n_words, round(r.log_score, 6)) for r in got.collect()) == sorted(
        (i, n, round(s, 6)) for i, n, s in slow_scores(rows))


def test_hashes_have_small_row_groups(spark, make_docs, monkeypatch):
    """Every pass reads the hashes by the numbers of their row group's words."""
    monkeypatch.setattr(backoff, "ROW_GROUP", 20_000)
    tables, write = [], backoff.written

    def noted(df, name, **options):
        tables.append((name, write(df, name, **options)))
        return tables[-1][1]
    monkeypatch.setattr(backoff, "written", noted)
    backoff.scores(make_docs([(i, " ".join(f"{i}-{j}" for j in range(20))) for i in range(2_000)]).coalesce(1), order=1)
    files = [f.removeprefix("file:") for name, table in tables if name == "word-hashes" for f in table.inputFiles()]
    assert files and max(pq.ParquetFile(f).num_row_groups for f in files) > 1
