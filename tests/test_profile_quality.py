import random

import numpy as np
from pyspark.sql import functions as F

from starbuild.operators import profile as P
from starbuild.operators import quality as Q


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(7)
    vals = [float(rnd.choice([rnd.randint(0, 50), rnd.random() * 1000, 5])) for _ in range(3000)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "a double, b double")
    got = {(r.column, r.p): r.value for r in P.exact_quantiles(df, ["a", "b"], (0.1, 0.5, 0.9),
                                                               num_partitions=5).collect()}
    for c, arr in (("a", np.array(vals)), ("b", np.array(vals) * 2)):
        for p in (0.1, 0.5, 0.9):
            assert abs(got[(c, p)] - np.quantile(arr, p)) < 1e-9


def test_profile_numeric_exact_sums(spark):
    df = spark.createDataFrame([(1, 2.5), (2, None), (3, 3.5), (None, 4.0)],
                               "k int, x double").select("k", F.col("x").cast("decimal(10,2)").alias("x"))
    rows = {r.column: r for r in P.profile_numeric(df).collect()}
    assert rows["k"]["count"] == 3 and rows["k"].mean == 2.0 and rows["k"].std == 1.0
    assert rows["k"].missing == 1 and rows["k"].unique_values == 3 and rows["k"].q50 == 2.0
    assert rows["x"].min == 2.5 and rows["x"].max == 4.0 and rows["x"].q50 == 3.5


def test_distinct_counts_null_counted_vs_ignored(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert P.distinct_counts(df).collect()[0].distinct_values == 3
    assert P.profile_string(df).collect()[0].unique_values == 2


def test_fill_rates_bround(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(1, 1)] * 5 + [(None, None)] * 0,
                               "a int, b int")
    rows = {r.column: r for r in P.column_fill_rates(df).collect()}
    assert rows["a"].fill_pct == 100.0 and rows["b"].fill_pct == 62.5 and rows["b"].rows == 8
    df2 = spark.createDataFrame([(1,)] * 1 + [(None,)] * 7, "a int")   # 12.5 -> 12.5
    df3 = spark.createDataFrame([(1,)] * 3 + [(None,)] * 37, "a int")  # 7.5 -> 7.5 (scale 1)
    assert P.column_fill_rates(df2).collect()[0].fill_pct == 12.5
    assert P.column_fill_rates(df3, scale=0).collect()[0].fill_pct == 8.0  # half-even


def test_low_cardinality_values(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "y", None) for i in range(20)],
                               "k int, flag string, empty string")
    got = sorted((r.column, r.value) for r in P.low_cardinality_values(df, max_values=10).collect())
    assert got == [("flag", "x"), ("flag", "y")]


def test_group_size_balance_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    r = P.group_size_balance(df, "k").collect()[0]
    assert (r.groups, r.rows, r.largest_group, r.largest_rows) == (3, 4, "c", 2)
    assert (r.smallest_group, r.smallest_rows) == ("a", 1)


def test_period_overlap_none_and_some(spark):
    import datetime as dt
    a = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 10),)], "d date")
    b = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 2, 1),)], "d date")
    c = spark.createDataFrame([(dt.date(2021, 1, 5),)], "d date")
    assert P.period_overlap(a, "d", b, "d").collect()[0].overlap_days == 6
    assert P.period_overlap(a, "d", c, "d").collect()[0].overlap_days is None


def test_reconcile_counts(spark):
    stage = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    out = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    r = Q.reconcile_counts(stage, "k", out, "k").collect()[0]
    assert (r.stage_rows, r.output_rows, r.row_diff) == (4, 3, 1)
    assert (r.stage_unique, r.output_unique, r.keys_equal, r.duplicates) == (3, 2, False, 1)


def test_join_coverage_dim_side_and_duplicate_dim_keys(spark):
    fact = spark.createDataFrame([(1, "JFK"), (2, " JFK "), (3, "NYC"), (3, "NYC"), (4, None)],
                                 "id int, airport string")
    dim = spark.createDataFrame([("JFK",), ("JFK",), ("LAX",)], "iata_code string")
    r = Q.join_coverage(fact, "airport", dim, "iata_code").collect()[0]
    assert (r.matched, r.unmatched, r.total, r.matched_pct) == (2, 2, 4, 50.0)
    top = Q.unmatched_keys(fact, "airport", dim, "iata_code").collect()
    assert [(t.fk, t.pairs) for t in top] == [("NYC", 1), (None, 1)]


def test_hidden_duplicates_and_code_list(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3)], "t string, v int")
    assert [(r.t, r.v, r.copies) for r in Q.hidden_duplicates(df, ["t", "v"]).collect()] == \
        [("a", 1, 2)]
    codes = spark.createDataFrame([("a",), ("b",)], "code string")
    assert [(r.value, r.rows) for r in Q.code_list_violations(df, "t", codes).collect()] == \
        [("c", 1)]


def test_coverage_without_pair_distinct_for_unique_ids(spark):
    fact = spark.createDataFrame([(1, "JFK"), (2, " JFK "), (3, "NYC"), (4, None)],
                                 "id int, airport string")
    dim = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")
    a = Q.join_coverage(fact, "airport", dim, "iata_code").collect()[0]
    b = Q.join_coverage(fact, "airport", dim, "iata_code", distinct_pairs=False).collect()[0]
    assert a == b and (b.matched, b.unmatched) == (2, 2)


def test_approximate_profiles_close_to_exact(spark):
    df = spark.range(0, 20000).select((F.col("id") % 997).alias("k"),
                                      (F.col("id") % 13).cast("double").alias("x"))
    exact = {r.column: r for r in P.profile_numeric(df).collect()}
    approx = {r.column: r for r in P.profile_numeric(df, approx=True).collect()}
    for c in ("k", "x"):
        assert approx[c]["count"] == exact[c]["count"]
        assert abs(approx[c].unique_values - exact[c].unique_values) <= 0.05 * exact[c].unique_values
        assert abs(approx[c].q50 - exact[c].q50) <= 0.01 * (exact[c]["max"] - exact[c]["min"]) + 1
    d = {r.column: r.distinct_values for r in P.distinct_counts(df, approx=True).collect()}
    assert abs(d["k"] - 997) <= 50 and abs(d["x"] - 13) <= 1
    plan = P.distinct_counts(df, approx=True)._jdf.queryExecution().executedPlan().toString()
    assert "HyperLogLogPlusPlus" in plan or "approx_count_distinct" in plan


def test_reconcile_counts_approx(spark):
    stage = spark.range(0, 5000).select((F.col("id") % 2000).alias("k"))
    out = spark.range(0, 2000).select(F.col("id").alias("k"))
    exact = Q.reconcile_counts(stage, "k", out, "k").collect()[0]
    est = Q.reconcile_counts(stage, "k", out, "k", approx=True).collect()[0]
    assert (est.stage_rows, est.output_rows) == (exact.stage_rows, exact.output_rows)
    assert abs(est.stage_unique - 2000) <= 100 and abs(est.output_unique - 2000) <= 100


def test_numeric_profile_of_large_and_missing_values(spark):
    """Ids above 2**53, epoch milliseconds, NaN and NULL."""
    import math
    n = 1000
    rows = [(2**53 + 2 * i + 1, 1_500_000_000_000 + i, math.nan if i % 4 == 0 else None if i % 4 == 1 else float(i))
            for i in range(n)] + [(9 * 10**18, None, None)]
    df = spark.createDataFrame(rows, "big long, ms long, x double")
    got = {r["column"]: r for r in P.profile_numeric(df).collect()}
    assert got["big"].unique_values == n + 1 and got["big"].std > 0
    assert abs(got["ms"].std - np.std(np.arange(n), ddof=1)) < 1e-6
    x = np.array([float(i) for i in range(n) if i % 4 > 1])
    assert got["x"]["count"] == len(x) and got["x"].missing == n + 1 - len(x)
    assert abs(got["x"].mean - x.mean()) < 1e-9 and got["x"].max == x.max() and abs(got["x"].std - x.std(ddof=1)) < 1e-9
    assert abs(got["x"].q50 - np.quantile(x, 0.5)) < 1e-9
    small = spark.createDataFrame([(10**9 + i,) for i in range(3)], "a long")
    assert P.profile_numeric(small).first().std == 1.0
    assert {r["column"]: r.missing for r in P.columns_with_missing(df).collect()} == {"ms": 1, "x": n + 1 - len(x)}


def test_sample_does_not_depend_on_splits(spark):
    from starbuild.sources.readers import sample_rows
    df = spark.range(5000).select("id", (F.col("id") * 2).alias("v"))
    a = {r.id for r in sample_rows(df, 0.2, 7, ["id"]).collect()}
    b = {r.id for r in sample_rows(df.repartition(13), 0.2, 7, ["id"]).collect()}
    assert a == b and 850 < len(a) < 1150
    assert a != {r.id for r in sample_rows(df, 0.2, 8, ["id"]).collect()}


def test_hidden_duplicates_filters_wide_rows_before_the_shuffle(spark):
    rows = [(f"text {i} " * 20,) for i in range(300)] + [("twice " * 20,)] * 2 + [(None,)] * 2
    df = spark.createDataFrame(rows, "text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.hidden_duplicates(df, ["text"])
        assert {(r.text, r.copies) for r in out.collect()} == {("twice " * 20, 2), (None, 2)}
        lines = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
        bits = [i for i, x in enumerate(lines) if "BroadcastHashJoin" in x]
        spread = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
        assert bits and spread and spread[0] < bits[0]      # the bit filter stands below the first shuffle
        assert not any("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in lines)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_filter_passes_all_keys_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(Q, "FILTER_BITS", 1 << 20)
    keys = spark.range(40_000).select(F.xxhash64("id").alias("h"))
    bits = Q.key_filter(keys, "h").checkpoint()
    assert bits.count() == 32 and bits.agg(F.sum(F.length("bits"))).first()[0] == 32 * 4096
    assert Q.passing(keys, "h", bits).count() == 40_000
    others = spark.range(10**6, 2 * 10**6).select("id", F.xxhash64("id").alias("h"))
    passed = Q.passing(others, "h", bits)
    assert passed.columns == ["id", "h"] and 0.03 < passed.count() / 10**6 < 0.045      # 40,000 / 2^20


def test_key_filter_at_its_size(spark):
    """Ten million candidates: at least 95 % of the other rows stop, the filter stays within 32 MB."""
    bits = Q.key_filter(spark.range(10**7).select(F.xxhash64("id").alias("h")), "h").checkpoint()
    assert bits.count() <= 8192
    others = spark.range(10**8, 10**8 + 10**6).select(F.xxhash64("id").alias("h"))
    assert Q.passing(others, "h", bits).count() < 50_000


def test_a_text_with_a_third_of_all_rows_is_combined_in_the_map_tasks(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot " * 500).otherwise(F.col("id").cast("string")).alias("t"))
    out = Q.hidden_duplicates(df, ["t"])
    assert [(r.t, r.copies) for r in out.collect()] == [("hot " * 500, 1000)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    top = plan[:plan.index("Exchange hashpartitioning") + 2000]
    assert "partial_count(1)" in top and "SortMergeJoin" not in plan
