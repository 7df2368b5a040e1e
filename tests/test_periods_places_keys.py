"""Covered days, near places and most frequent keys against brute force."""
import datetime as dt
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starbuild.operators import locations as L
from starbuild.operators import periods as R
from starbuild.operators import profile as P
from starbuild.operators import quality as Q

DAY = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def cover_of(rows):
    return {DAY + dt.timedelta(days=i) for s, e in rows if s is not None for i in range(s, (s if e is None else e) + 1)}


def stretches(days):
    out = []
    for d in sorted(days):
        if out and (d - out[-1][1]).days == 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(a, b, (b - a).days + 1) for a, b in out]


def frame(spark, rows):
    return spark.createDataFrame([(day(s), day(e)) for s, e in rows], "s date, e date")


RANGES = st.lists(st.tuples(st.one_of(st.none(), st.integers(-40, 40)), st.one_of(st.none(), st.integers(-40, 60))), max_size=12)


@settings(max_examples=8, deadline=None)
@given(RANGES, RANGES)
def test_covers_and_overlap(spark, a, b):
    left, right = cover_of(a), cover_of(b)
    fa, fb = frame(spark, a), frame(spark, b)
    assert sorted(map(tuple, R.islands(R.covered_days(fa, "s", "e")).collect())) == stretches(left)
    assert R.overlap_days(fa, "s", fb, "s", "e", "e").first() == (len(left), len(right), len(left & right))
    shared = R.shared_days(R.covered_days(fa, "s", "e"), R.covered_days(fb, "s", "e"))
    assert sorted(map(tuple, R.islands(shared).collect())) == stretches(left & right)


def test_gaps_do_not_count(spark):
    a = frame(spark, [(0, None), (10, None), (20, None)])
    b = frame(spark, [(5, None), (10, None), (30, None)])
    assert R.overlap_days(a, "s", b, "s").first() == (3, 3, 1)
    assert P.period_overlap(a, "s", b, "s").first().overlap_days == 16        # first to last day


def test_long_history_spans_bitmaps(spark):
    df = spark.createDataFrame([(dt.date(1, 1, 1), dt.date(1, 1, 3)), (dt.date(1850, 1, 1), dt.date(2025, 12, 31)),
                                (dt.date(9999, 12, 30), dt.date(9999, 12, 31))], "s date, e date")
    cover = R.covered_days(df, "s", "e")
    assert cover.count() <= 6 and R.covered_days(df.where("false"), "s").count() == 0
    assert sorted(r.days for r in R.islands(cover).collect()) == [2, 3, (dt.date(2025, 12, 31) - dt.date(1850, 1, 1)).days + 1]


# ---- places

def distance(a, b):
    p, q = (tuple(map(math.radians, x)) for x in (a, b))
    h = math.sin((q[0] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(q[0]) * math.sin((q[1] - p[1]) / 2) ** 2
    return 2 * L.EARTH_METRES * math.asin(min(1, math.sqrt(h)))


def slow_pairs(points, limit):
    count = Counter((la, 0.0 if abs(la) == 90 else (lo + 180) % 360 - 180) for la, lo in points)
    some = sorted(count)
    return sorted((*a, count[a], *b, count[b]) for i, a in enumerate(some) for b in some[i + 1:] if distance(a, b) <= limit)


@pytest.mark.parametrize("limit", [1000.0, 80_000.0, 3_000_000.0, 30_000_000.0])
@pytest.mark.parametrize("block", [1, 5, 4096])
def test_near_places(spark, monkeypatch, limit, block):
    monkeypatch.setattr(L, "BLOCK_PLACES", block)
    rnd = random.Random(int(limit) + block)
    spread = limit / 111_000 * 1.5
    points = [(90.0, 10.0), (90.0, -50.0), (-90.0, 0.0), (89.9999, 5.0), (89.9999, -175.0), (0.0, 180.0), (0.0, -180.0), (0.0, 540.0),
              (0.0, 179.9995), (0.0, -179.9995), (51.5, 0.0), (51.5, 0.0)]
    points += [(max(-90.0, min(90.0, 40 + rnd.uniform(-spread, spread))), 179.99 + rnd.uniform(-spread, spread)) for _ in range(25)]
    points += [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(25)]
    df = spark.createDataFrame(points, "lat double, lon double")
    got = L.near_locations(df, "lat", "lon", limit).collect()
    assert sorted(tuple(r)[:6] for r in got) == slow_pairs(points, limit)
    assert all(r.metres == pytest.approx(distance((r.lat, r.lon), (r.near_lat, r.near_lon)), abs=1e-3) for r in got)


def test_bad_coordinates_and_copies(spark):
    rows = [(1.0, 2.0)] * 500 + [(1.0, 2.00001)] * 3 + [(None, 2.0), (1.0, None), (91.0, 0.0), (math.nan, 0.0), (0.0, math.inf)]
    found = L.near_locations(spark.createDataFrame(rows, "lat double, lon double"), "lat", "lon", 10.0).collect()
    assert [(r.rows, r.near_rows) for r in found] == [(500, 3)]
    assert L.near_locations(spark.createDataFrame([], "lat double, lon double"), "lat", "lon", 10.0).collect() == []


# ---- keys

def full_ranking(values, k):
    count = Counter(values)
    return sorted(count.items(), key=lambda x: (-x[1], x[0] is None, x[0] if x[0] is not None else 0))[:k]


@pytest.mark.parametrize("k", [1, 3, 10, 500])
@pytest.mark.parametrize("slots", [1, 16, 1 << 12])
def test_top_keys_equal_the_ranking(spark, k, slots):
    rnd = random.Random(k * slots)
    for values in ([int(rnd.paretovariate(0.7)) % 10_000 for _ in range(3000)], list(range(300)),      # skewed, all ties
                   [i % 20 for i in range(400)] + [None] * 25, [None] * 5, [rnd.randrange(150) for _ in range(2000)]):
        df = spark.createDataFrame([(v,) for v in values], "x long")
        got = [tuple(r) for r in Q.top_keys(df, "x", k, slots, first_slots=4).collect()]
        assert got == full_ranking(values, k)
    assert Q.top_keys(spark.createDataFrame([], "x long"), "x", k).collect() == []


def test_top_keys_shuffle_few_counts(spark, monkeypatch):
    """Of 60,000 keys only those of the fullest slots are counted one by one."""
    df = spark.range(60_000).select(F.explode(F.array_repeat("id", F.when(F.col("id") < 10, 3000).otherwise(1).cast("int"))).alias("x"))
    made = []
    plain = type(df).groupBy

    def group_by(frame, *cols):
        if cols == ("key",):
            made.append(frame.select("key").distinct().count())
        return plain(frame, *cols)

    monkeypatch.setattr(type(df), "groupBy", group_by)
    got = Q.top_keys(df, "x", 10, slots=1 << 12)
    assert sorted(r.key for r in got.collect()) == list(range(10)) and made and sum(made) < 3000


def test_unmatched_keys_by_counters(spark):
    rows = [(i, f" k{i % 37} " if i % 5 else None) for i in range(600)]
    fact = spark.createDataFrame(rows, "id int, fk string")
    dim = spark.createDataFrame([(f"k{i}",) for i in range(0, 37, 4)], "code string")
    for top in (1, 7, 40):
        plain = Q.unmatched_keys(fact, "fk", dim, "code", top=top, distinct_pairs=False).collect()
        assert Q.unmatched_keys(fact, "fk", dim, "code", top=top, distinct_pairs=False, counters=True).collect() == plain


# ---- one scan

def test_one_scan_counts_equal_the_others(spark):
    rows = [(i % 7, None if i % 3 else f"t{i % 5}", float("nan") if i % 4 == 0 else -0.0 if i % 4 == 1 else 0.0, {"k": i % 2}) for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b string, c double, m map<string,int>").withColumn("n", F.lit(None).cast("date"))
    for f in (P.distinct_counts, P.column_profile, P.profile_string):
        assert sorted(map(str, f(df, one_scan=True).collect())) == sorted(map(str, f(df).collect()))


def test_one_scan_parses_text_once(spark, tmp_path):
    spark.range(50).select(*[(F.col("id") % n).alias(f"c{n}") for n in range(2, 9)]).write.option("header", True).csv(str(tmp_path / "t"))
    raw = spark.read.option("header", True).csv(str(tmp_path / "t"))
    one, many = P.distinct_counts(raw, one_scan=True), P.distinct_counts(raw)
    scans = [d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan csv") for d in (one, many)]
    assert scans == [1, 7] and {r["column"]: r.distinct_values for r in one.collect()} == {f"c{n}": n for n in range(2, 9)}
