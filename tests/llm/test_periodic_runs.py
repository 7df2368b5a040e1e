"""Periodic runs against a plain search of all periods."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starbuild.llm.periodic_runs import periodic_runs, runs_of, runs_of_texts
from starbuild.llm.queries import op13_periodic_runs


def slow_runs(words, least=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, 2 * q))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def check(words):
    assert [tuple(r) for r in runs_of(np.array(words, np.int64)).tolist()] == slow_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=150), st.integers(0, 5), st.lists(st.integers(0, 2), max_size=20))
def test_random_words(head, times, tail):
    check(head * (times % 3 + 1) + tail * times)


@pytest.mark.parametrize("n", [1, 12, 13, 100, 377, 610])
def test_fibonacci_words(n):
    check(fibonacci(n))
    check([7, *fibonacci(n), 8])


@pytest.mark.parametrize("small", [1, 2, 3, 5, 7])
def test_roots_that_are_highly_periodic_themselves(small):
    """A run whose root repeats a smaller period: its only break is in the middle."""
    v = list(range(small))
    for length in range(12, 90, 5):
        u = (v * 100)[:length]
        for before, after in (([], []), ([9], [8]), ([small - 1], [0]), (u[:3], u[-2:])):
            check([*before, *u, *u, *after])
            check([*before, *u, 5, *u, 5, *u[:4], *after])


def test_long_periods_and_chains():
    rnd = random.Random(3)
    for period in (12, 13, 24, 47, 48, 95, 200):
        root = [rnd.randrange(40) for _ in range(period)]
        for length in (2 * period - 1, 2 * period, 3 * period + 5):
            check([41, *(root * 4)[:length], 42, *(root * 4)[3:length]])


def test_texts_do_not_meet():
    texts = [[1] * 20, [], [1] * 11, [1, 2] * 7, [2, 1] * 9]
    got = runs_of_texts([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [slow_runs(t) for t in texts]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


ORDER = lambda r: (r[0] is None, r[0] or 0, str(r))


def test_query_equals_brute_force(spark, sf_dir):
    docs = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
            if len(r.text or "") < 12000]
    assert any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in docs)
    got = {r[0]: tuple(r) for r in op13_periodic_runs(spark, sf_dir).collect()}
    for r in docs:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
    assert op13_periodic_runs(spark, sf_dir).columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_trouble_and_clashing_names(spark, trouble, clashing):
    change = "crc32(cast(string(doc_id) as binary))"
    for docs in (trouble, clashing):
        got = sorted((tuple(r) for r in periodic_runs(docs, change).drop("n_dropped").collect()), key=ORDER)
        want = sorted((expected(r.doc_id, r.text) for r in trouble.collect() if len(r.text or "") < 30000), key=ORDER)
        assert [r for r in got if r[0] != 7] == want
        long = next(r for r in got if r[0] == 7)       # one phrase three thousand times
        assert long[1:6] == (1, 0, 9000, 3, 3000000)


def test_empty_table_and_text_ids(spark, make_docs):
    assert periodic_runs(make_docs([])).count() == 0
    docs = spark.createDataFrame([("x", "a " * 15), (None, None)], "doc_id string, text string")
    assert {r.id: (r.n_runs, r.length, r.n_dropped) for r in periodic_runs(docs).collect()} == {"x": (1, 15, 14), None: (0, None, 0)}


def test_very_long_text(make_docs):
    text = " ".join(str(i % 70_000) for i in range(150_000)) + " z" * 30
    row = periodic_runs(make_docs([(1, text)])).first()
    assert (row.n_runs, row.start, row.length, row.period) == (2, 0, 150_000, 70_000)
