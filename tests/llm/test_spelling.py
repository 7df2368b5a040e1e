"""Spelling variants against plain comparisons of all words."""
import zlib
from collections import Counter
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starbuild.llm import spelling
from starbuild.llm.queries import op11_spelling_variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(count, ratio=10):
    form, out = {}, []
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * n else None
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], None if form[w] is None else count[form[w]], root))
    return sorted(out)


def slow_counts(rows, every=31, least=7):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                count[run] += 1
    return {w: n for w, n in count.items() if n > 1}


def frame(spark, count):
    return spark.createDataFrame(list(count.items()), "word string, n long")


COUNT = {"analysis": 1000, "analyses": 90, "analysys": 9, "analysiss": 8, "anlysis": 3, "nalysis": 3, "analyssi": 2,
         "aaaaaaa": 50, "aaaaaaaa": 500, "aaaaaaaaa": 5000, "aaaaaaab": 2, "baaaaaaa": 2, "iaaaaaaa": 500,
         "été÷été": 40, "été÷éte": 4, "éte÷éte": 2, "unrelated": 7, "tieword": 20, "tiewore": 200, "tieworf": 200}


@pytest.mark.parametrize("most", [0, 1, 2, 256])
def test_words_by_both_ways(spark, most):
    """Every pair through reduced words (256), every pair by letters (0), and mixtures."""
    got = sorted(map(tuple, spelling.variants(frame(spark, COUNT), most=most).collect()))
    assert got == slow_variants(COUNT)


@settings(max_examples=6, deadline=None)
@given(st.sets(st.text("aiqé", min_size=3, max_size=6), min_size=2, max_size=60), st.integers(0, 4))
def test_one_class_many_words(spark, words, most):
    """Letters of one or two symbols: classes hold many words."""
    count = {w: 1 + len(w) * 7 + i % 50 * 20 for i, w in enumerate(sorted(words))}
    pairs = {tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(frame(spark, count), most).collect()}
    assert pairs == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert spelling.near_pairs(frame(spark, count), most).count() == len(pairs)


def test_reduced_neighbourhoods_hold_every_pair():
    """The method's claim: an edit of a word is at most one edit of its reduced word."""
    low = lambda w: "".join(str(ord(c) % spelling.SYMBOLS) for c in w)
    for w in ("analysis", "été÷été"):
        for i in range(len(w) + 1):
            for c in "aiéz":
                for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]):
                    assert low(v) == low(w) or one_edit(low(v), low(w))


def test_long_chain_of_forms(spark):
    count = {"abcdefg" + "x" * i: 10 ** (i + 1) for i in range(9)}
    got = sorted(map(tuple, spelling.variants(frame(spark, count)).collect()))
    assert got == slow_variants(count) and {r[5] for r in got} == {"abcdefg" + "x" * 8}


def test_query_words_and_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.word: r.n for r in op11_spelling_variants(spark, sf_dir).collect()}
    assert got == slow_counts(docs)


def test_trouble_and_clashing_names(spark, trouble, clashing):
    rows = [(r.doc_id, r.text) for r in trouble.collect()]
    for docs in (trouble, clashing):
        got = sorted(map(tuple, spelling.spelling_variants(docs, least_length=1, every=31).collect()))
        assert got == slow_variants(slow_counts(rows, least=1))


def test_empty_table(make_docs):
    assert spelling.spelling_variants(make_docs([])).count() == 0


def test_pieces_keep_words_whole():
    text = "alpha Beta, gamma " * 50 + "x" * 300 + " ÉÀ÷ end"
    for size in (1, 7, 64, 10_000):
        assert "".join(spelling.pieces(text, size)) == text
        counts = Counter(w for p in spelling.pieces(text, size) for w in re.findall(r"[A-Za-zÀ-ÿ]+", p))
        assert counts == Counter(re.findall(r"[A-Za-zÀ-ÿ]+", text))
