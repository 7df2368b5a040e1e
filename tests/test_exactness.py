"""Legal inputs at the edges of their types: counts, quantiles, means, joins and
partition values stay exact."""
import datetime as dt
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starbuild.operators import aggregates as A
from starbuild.operators import dims as D
from starbuild.operators import facts as FT
from starbuild.operators import joins as J
from starbuild.operators import profile as P
from starbuild.operators import quality as Q
from starbuild.operators import selection as S
from starbuild.sources import readers, sinks


# ---- selection

def ranks(spark, values, kind, few=None, monkeypatch=None, wanted=None):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    n = len(values)
    wanted = wanted or sorted({0, n - 1, n // 2, n // 4, 3 * n // 4, min(1, n - 1)})
    got = S.values_at_ranks(df, df.schema[0].dataType, {"v": (n, min(values), max(values), wanted)})
    return [got["v", r] for r in wanted], [sorted(values)[r] for r in wanted]


@pytest.mark.parametrize("few", [1, 3, S.FEW])
def test_ranks_of_every_kind(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW", few)
    monkeypatch.setattr(S, "BINS", 8)
    rnd = random.Random(few)
    cases = [("long", [rnd.randrange(-2**63, 2**63) for _ in range(200)]),
             ("long", [2**63 - 1, -2**63, 2**53 + 1, 2**53 + 2, 2**53 + 3, 0, 0, 1]),
             ("long", [5] * 40), ("long", list(range(300))),
             ("double", [rnd.random() * 10 ** rnd.randrange(-300, 300) for _ in range(150)]),
             ("double", [1.0 + i * 2.0 ** -52 for i in range(60)] + [1e308, -1e308, math.inf, -math.inf, math.inf]),
             ("double", [0.0, -0.0, 5e-324, 1e-323, -5e-324] * 5),
             ("decimal(38,0)", [Decimal(rnd.randrange(-10**38 + 1, 10**38)) for _ in range(120)]),
             ("decimal(38,18)", [Decimal(rnd.randrange(10**38)).scaleb(-18) for _ in range(100)]),
             ("decimal(38,18)", [Decimal(10**37 + i).scaleb(-18) for i in range(100)]),
             ("decimal(38,38)", [Decimal(i).scaleb(-38) for i in (1, 2, 3, 10**37, 9 * 10**37)]),
             ("decimal(9,2)", [Decimal(rnd.randrange(10**9)).scaleb(-2) for _ in range(200)])]
    for kind, values in cases:
        got, want = ranks(spark, values, kind)
        assert got == want, kind


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60), st.integers(1, 8))
def test_ranks_of_any_doubles(spark, values, few):
    before = S.FEW, S.BINS
    S.FEW, S.BINS = few, 16
    try:
        got, want = ranks(spark, values, "double")
        assert got == want
    finally:
        S.FEW, S.BINS = before


def test_quantiles_over_many_columns_and_types(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(10**6), rnd.choice([1.5, 2.5, math.nan, None, rnd.gauss(0, 1e6)]),
             Decimal(rnd.randrange(10**12)).scaleb(-4), rnd.randrange(5), None) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a long, b double, c decimal(20,4), d int, e double")
    got = {(r["column"], r.p): r.value for r in P.exact_quantiles(df, df.columns, (0.0, 0.25, 0.9, 1.0)).collect()}
    for i, c in enumerate("abcd"):
        x = np.array([float(r[i]) for r in rows if r[i] is not None and not math.isnan(r[i])])
        for p in (0.0, 0.25, 0.9, 1.0):
            assert got[c, p] == pytest.approx(np.quantile(x, p), rel=1e-12)
    assert not [k for k in got if k[0] == "e"]


def test_selection_shuffles_bins_only(spark, monkeypatch):
    """No exchange of values: what is shuffled is bounded by bins, not by rows."""
    monkeypatch.setattr(S, "FEW", 64)
    monkeypatch.setattr(S, "BINS", 32)
    made = []
    plain = type(spark.range(1)).collect

    def collect(df):
        rows = plain(df)
        made.append((len(rows), df._jdf.queryExecution().executedPlan().toString()))
        return rows

    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"))
    got = S.values_at_ranks(df, df.schema[0].dataType, {"x": (20_000, 0.0, 20_010.0, [10_000])})
    assert got["x", 10_000] == sorted(i * 7919 % 20_011 for i in range(20_000))[10_000]
    assert 2 <= len(made) <= 4 and all(n <= 2 for n, _ in made)
    assert all("rangepartitioning" not in plan for _, plan in made)


def test_numeric_profile_of_wide_decimals(spark):
    big = Decimal(10) ** 30
    df = spark.createDataFrame([(big, Decimal("1.5")), (Decimal(9) * 10**37, Decimal("2.25")), (-Decimal(9) * 10**37, None)],
                               "a decimal(38,0), b decimal(20,18)")
    rows = {r["column"]: r for r in P.profile_numeric(df).collect()}
    assert rows["a"].q50 == 1e30 and rows["a"].unique_values == 3 and rows["a"]["max"] == 9e37
    assert rows["a"].std == pytest.approx(9e37) and rows["a"].mean == pytest.approx(1e30 / 3)
    assert (rows["b"].mean, rows["b"].q50, rows["b"].missing) == (1.875, 1.875, 1)


# ---- keys and profiles

def test_key_counts_by_value(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 1), (math.nan, 2), (math.nan, None)], "x double, k int")
    got = {r["column"]: (r["rows"], r["uniq"]) for r in Q.key_counts(df, ["x", "k"]).collect()}
    assert got == {"x": (4, 2), "k": (4, 3)}
    assert {r["column"]: r.distinct_values for r in P.distinct_counts(df).collect()} == {"x": 2, "k": 3}


def test_key_counts_when_the_zone_repeats_an_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1667107800 + 3600 * i,) for i in (0, 168, 169, 170)], "s long").select(
            F.timestamp_seconds("s").alias("t"), F.col("s").cast("string").alias("k"))
        assert {r["column"]: r["uniq"] for r in Q.key_counts(df, ["t", "k"]).collect()} == {"t": 4, "k": 4}
        assert Q.reconcile_counts(df, "t", df, "t").first().duplicates == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_profiles_of_map_columns(spark):
    rows = [({"a": 1, "b": 2}, [({"x": {"y": 1}},)], 1), ({"b": 2, "a": 1}, [({"x": {"y": 1}},)], 1),
            ({"a": 1}, [({"x": {"y": 2}},)], 2), (None, None, 2)]
    df = spark.createDataFrame(rows, "m map<string,int>, n array<struct<s:map<string,map<string,int>>>>, k int")
    assert {r["column"]: r.distinct_values for r in P.distinct_counts(df).collect()} == {"m": 3, "n": 3, "k": 2}
    assert {r["column"]: r.unique_values for r in P.profile_string(df).collect()} == {"m": 2, "n": 2}
    assert {r["column"]: (r.unique_values, r.missing) for r in P.column_profile(df).collect()} == {
        "m": (3, 1), "n": (3, 1), "k": (2, 0)}
    got = {(r["column"], r.value) for r in P.low_cardinality_values(df).collect()}
    assert {v for c, v in got if c == "m"} == {"{a -> 1, b -> 2}", "{a -> 1}"} and len(got) == 6
    assert {r["column"]: r.distinct_values for r in P.distinct_counts(df, approx=True).collect()}["m"] == 3
    assert P.summarize(df)["values"].count() == 6


# ---- weighted means

def test_weighted_mean_of_large_integers(spark):
    big = 2**63 - 1
    df = spark.createDataFrame([("a", 100_000, 100_000, big, big), ("a", 3, 1, big - 2, big), ("b", None, 5, None, 1)],
                               "k string, m int, w int, bm long, bw long")
    got = {r.k: r.weighted_avg for r in A.weighted_average(df, "m", "w", "k").collect()}
    assert got["a"] == (100_000 * 100_000 + 3) / 100_001 and got["b"] is None
    got = {r.k: r.weighted_avg for r in A.weighted_average(df, "bm", "bw", "k").collect()}
    assert got["a"] == pytest.approx(big - 1) and got["b"] is None
    dim = D.group_rollup_dimension(df, "k", ["w"], "m", "w", dedupe_rows=False)
    assert {r.k: (r.w, r.m) for r in dim.collect()}["a"] == (100_001, (100_000 * 100_000 + 3) / 100_001)


def test_weighted_mean_beyond_decimals(spark):
    x = Decimal(9) * 10**37
    df = spark.createDataFrame([("a", x, x), ("a", x, x), ("b", Decimal(2), Decimal(3))], "k string, m decimal(38,0), w decimal(38,0)")
    got = {r.k: r.weighted_avg for r in A.weighted_average(df, "m", "w", "k").collect()}
    assert got == {"a": pytest.approx(9e37), "b": 2.0}


# ---- partition values

TEXTS = ["", "A", None, "~", "~A", "~~", "__HIVE_DEFAULT_PARTITION__", "01", "1", "a/b=c%", " x ", "é"]


@pytest.mark.parametrize("cluster", ["none", "range"])
def test_partition_texts_come_back(spark, tmp_path, cluster):
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "id int, code string, part int")
    path = sinks.write_parquet(df, str(tmp_path / "t"), partition_by=["code", "part"], cluster=cluster)
    back = sinks.read_parquet(spark, path, df.schema, ["code", "part"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    one = back.where("code = ''")
    assert [r.id for r in one.collect()] == [0]
    files = {f.rsplit("/", 1)[0] for f in one.inputFiles()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_partitioned_fact_keeps_the_empty_code(spark, tmp_path):
    from starbuild.plans.star import StarSpec, run_star
    s = spark.createDataFrame([(i, p, "x", dt.date(2020, 1, 1)) for i, p in enumerate(["", "A", None, "~"])],
                              "id int, port string, f string, d date")
    spec = StarSpec(fact_name="facts", fact_key="id", flags=["f"], flag_dim_name="dim_f", flag_key="f_id",
                    date_columns=["d"], date_dim_name="dim_d", entity_name="dim_ports", entity_key="port",
                    entity_columns=["port"], entity_fk="port",
                    fact_layout=[("id", "id", "int"), ("port", "port", None), ("f_id", "f_id", None)])
    run = run_star(spark, s, spec, str(tmp_path), entity_src=s.select("port").distinct(), fact_partition_by=["port"])
    assert sorted(map(str, run.star.read(spark, "facts").select("id", "port").collect())) == sorted(
        map(str, s.select("id", "port").collect()))
    assert run.checks["coverage_facts_dim_ports"].first().matched == 3


def test_uri_paths(spark, tmp_path):
    """A destination and a source named by URI."""
    df = spark.createDataFrame([(1, "x"), (2, "")], "id int, p string")
    root = f"file://{tmp_path}"
    paths = sinks.write_tables({"a": df, "b": df}, root, {"b": ["p"]})
    assert paths == {"a": f"{root}/a", "b": f"{root}/b"}
    assert sorted(map(tuple, readers.read_staging(spark, paths["a"]).collect())) == [(1, "x"), (2, "")]
    assert sorted(map(tuple, sinks.read_parquet(spark, paths["b"], df.schema, ["p"]).collect())) == [(1, "x"), (2, "")]


# ---- salted join

def test_salt_widths():
    assert J.salt_widths({7: 5_500_000, 8: 10}, 100_000) == {7: 8, 8: 2}
    assert J.salt_widths({7: 10**12}, 64) == {7: 64}
    many = J.salt_widths({i: 10**10 for i in range(1000)}, 104_000)
    assert sum(many.values()) <= J.MAX_SALTED_ROWS and min(many.values()) >= 32
    assert sum(J.salt_widths(list(range(1000)), 100_000).values()) <= J.MAX_SALTED_ROWS
    assert J.salt_widths([1], 8, 4) == {1: 4}
    with pytest.raises(ValueError):
        J.salt_widths(range(J.MAX_SALTED_ROWS), 8)


def test_salted_side_is_bounded_whatever_the_partitions(spark, tmp_path):
    spark.createDataFrame([(f"k{i}", i) for i in range(3)], "a string, k int").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    n = 3000
    fact = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "k0").when(F.col("id") % 3 == 1, "k1")
                                 .when(F.col("id") % 7 == 0, "none").alias("a"))
    counts = fact.groupBy("a").agg(F.count("*").alias("rows"))
    hot = J.hot_of_counts(counts, ["a"], "rows", least=900)
    assert sorted(hot.values()) == [1000, 1000]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100000")
    try:
        for given in (hot, list(hot)):
            out = FT.attach_dimension_key(fact, dim, ["a"], "k", salt_by=["id"], hot=given)
            plan = out._jdf.queryExecution().optimizedPlan()
            made = sum(J.salt_widths(given, 100_000).values())
            assert made <= (4 if given is hot else J.MAX_SALTED_ROWS) and "Generate explode" in plan.toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = sorted(map(str, fact.join(dim, "a", "left").select("id", "a", "k").collect()))
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = FT.attach_dimension_key(fact, dim, ["a"], "k", salt_by=["id"], hot=hot)
            assert sorted(map(str, out.collect())) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
