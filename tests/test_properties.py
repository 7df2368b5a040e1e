"""Property tests against brute force on small, skewed inputs."""

import collections

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starbuild.operators import dims as D
from starbuild.operators import profile as P
from starbuild.operators import quality as Q
from starbuild.operators.sequence import with_sequence_id
from starbuild.sources import readers as R

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# A third of the rows on one hot key, the rest spread.
skewed = st.lists(st.one_of(st.just("HOT"), st.text("abc", min_size=0, max_size=3), st.none()),
                  min_size=1, max_size=60).map(lambda xs: xs + ["HOT"] * (len(xs) // 2))


@SETTINGS
@given(keys=st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 5)), min_size=1,
                     max_size=40, unique=True), parts=st.integers(1, 9))
def test_sequence_is_global_rank(spark, keys, parts):
    df = spark.createDataFrame(keys, "a string, b int")
    got = {(r.a, r.b): r.sid for r in with_sequence_id(df, ["a", "b"], "sid",
                                                       num_partitions=parts).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@SETTINGS
@given(fks=skewed, dim=st.lists(st.text("abc", max_size=3), max_size=8))
def test_join_coverage_brute_force(spark, fks, dim):
    fact = spark.createDataFrame([(i % 7, f) for i, f in enumerate(fks)], "id int, fk string")
    dim_df = spark.createDataFrame([(d,) for d in dim] or [("zzzz",)], "k string")
    pairs = {(i % 7, f.strip() if f is not None else None) for i, f in enumerate(fks)}
    keys = set(dim) or {"zzzz"}
    matched = sum(1 for _, f in pairs if f in keys)
    r = Q.join_coverage(fact, "fk", dim_df, "k").collect()[0]
    assert (r.matched, r.unmatched, r.total) == (matched, len(pairs) - matched, len(pairs))
    top = Q.unmatched_keys(fact, "fk", dim_df, "k", top=None).collect()
    want = collections.Counter(f for _, f in pairs if f not in keys)
    assert {(t.fk, t.pairs) for t in top} == set(want.items())


@SETTINGS
@given(vals=skewed)
def test_hidden_duplicates_brute_force(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = {(r.t, r.copies) for r in Q.hidden_duplicates(df, ["t"]).collect()}
    want = {(v, n) for v, n in collections.Counter(vals).items() if n >= 2}
    assert got == want


@SETTINGS
@given(vals=skewed)
def test_distinct_and_low_cardinality_brute_force(spark, vals):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "t string, i int")
    d = {r.column: r.distinct_values for r in P.distinct_counts(df).collect()}
    assert d == {"t": len(set(vals)), "i": len(vals)}
    low = {(r.column, r.value) for r in P.low_cardinality_values(df, max_values=4).collect()}
    non_null = {v for v in vals if v is not None}
    want = {("t", v) for v in non_null} if len(non_null) <= 4 else set()
    if len(vals) <= 4:
        want |= {("i", str(i)) for i in range(len(vals))}
    assert low == want


@SETTINGS
@given(w=st.lists(st.tuples(st.sampled_from(["A", "B", None]),
                            st.one_of(st.none(), st.integers(0, 9)),
                            st.integers(0, 5)), min_size=1, max_size=30))
def test_group_rollup_brute_force(spark, w):
    df = spark.createDataFrame(w, "k string, m int, wt int")
    got = {r.k: (r.wt, r.m) for r in D.group_rollup_dimension(df, "k", ["wt"], "m", "wt")
           .collect()}
    rows = set(w)
    want = {}
    for k in {r[0] for r in rows if r[0] is not None}:
        g = [r for r in rows if r[0] == k]
        num = sum(r[1] * r[2] for r in g if r[1] is not None)
        has_num = any(r[1] is not None for r in g)
        den = sum(r[2] for r in g)
        want[k] = (den, (num / den) if (has_num and den) else None)
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0]
        if want[k][1] is None:
            assert got[k][1] is None
        else:
            assert abs(got[k][1] - want[k][1]) < 1e-9


def test_read_in_chunks(spark):
    df = spark.range(100)
    assert R.read_in_chunks(df, 25, 10).count() == 30
    assert R.read_in_chunks(df, 250, 10).count() == 100


def test_summarize_keys(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, s string, e string")
    out = P.summarize(df)
    assert set(out) == {"numeric", "string", "missing", "values"}
    assert [r.column for r in out["missing"].collect()] == ["e"]


def test_skewed_pipeline_smoke(spark):
    """600k rows: a third on one hot flag combination, a third with a NULL
    flag.  The shuffle (salted) fact join, coverage and roll-up must keep
    every row exactly once."""
    from pyspark.sql import functions as F

    from starbuild.operators import facts as FT
    n = 600_000
    base = spark.range(0, n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            (F.col("id") % 50).cast("string")).alias("a"),
        F.when(F.col("id") % 3 == 1, F.lit(None).cast("string")).otherwise(F.lit("x")).alias("b"),
        (F.col("id") % 7).alias("w"))
    dim = D.combination_dimension(base, ["a", "b"], "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = FT.attach_dimension_key(base, dim, ["a", "b"], "k", salt_by=["id"])
        got = fact.agg(F.count(F.lit(1)).alias("rows"), F.count("k").alias("keyed"),
                       F.count_distinct("id").alias("ids")).collect()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    null_b = n // 3 + (1 if n % 3 > 1 else 0)
    assert (got.rows, got.ids, got.keyed) == (n, n, n - null_b)
    cov = Q.join_coverage(base, "a", dim, "a", id_col="id").collect()[0]
    assert cov.total == n and cov.matched == n        # every non-null 'a' is in the dim
    roll = {r.a: r.w for r in D.group_rollup_dimension(base, "a", ["w"], dedupe_rows=False)
            .collect()}
    assert roll["HOT"] == sum(i % 7 for i in range(0, n, 3))
