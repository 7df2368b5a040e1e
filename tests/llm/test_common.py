"""Helpers: salted joins, heavy keys, folds and name clashes."""
import zlib

import pytest

from starbuild.llm import common


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy", [[], [7], [7, 3]])
def test_spread_join_equals_a_plain_join(spark, how, heavy):
    left = spark.createDataFrame([(7 if i % 3 == 0 else i % 5 if i % 4 else None, i, "x") for i in range(300)],
                                 "key int, v int, __salt string")
    right = spark.createDataFrame([(k, f"r{k}") for k in (1, 3, 7, 9)], "key int, r string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = common.spread_join(left, right, "key", heavy, how, spread=5)
        want = left.join(right, "key", how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_are_few(spark):
    counts = spark.createDataFrame([(i, 10 if i else 5000) for i in range(500)], "k int, n int")
    assert common.heavy_keys(counts, "k", "n", 10_000, least=100) == [0]
    assert common.heavy_keys(counts, "k", "n", 10_000) == []


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.createDataFrame([(12,), (None,), (-3,)], "doc_id long")
    got = [r[0] for r in rows.select(common.fold("doc_id", 5)).collect()]
    assert got == [zlib.crc32(b"12") % 5, 0, zlib.crc32(b"-3") % 5]


def test_written_tables_go_to_the_shared_folder(spark):
    df = common.written(spark.range(5), "probe")
    assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
