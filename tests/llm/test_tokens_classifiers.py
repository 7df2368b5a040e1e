"""Token counts and the BPE automaton against the tokenizers library; the
classifiers by accuracy on labelled rows that they did not learn from."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starbuild.llm import bpe, byte_bpe, quality, token_count, toxicity
from starbuild.llm.queries import QUERIES, VOCABULARY
from tests_llm_helpers import digest

PIECES = ["a", "b", "the", " ", "\n", "\t", "é", "日本", "　", "'s", "'ll", "1", "²", "!", "<|endoftext|>", "🙂",
          "́", "\x1c", "\x85", "aaaa", "  ", "zz", "ing", "<|", "\xa0"]
HARD = ["a" * 5000, "ab" * 3000, " " * 3000, "-" * 5000, "abc" * 3333, "=" * 777, "\n" * 500, "", "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return HARD + ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(2000)]


def test_automaton_and_counter_equal_the_library(library, texts):
    v = byte_bpe.read_vocabulary(VOCABULARY)
    machine, counter = bpe.compile_automaton(v), token_count.TokenCounter.from_vocabulary(v)
    for t in texts:
        e = library.encode(t, add_special_tokens=False)
        ids = machine.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, t[:80]
        assert counter.count(t) == len(e.ids), t[:80]
        assert machine.decode(ids).decode("utf-8", "replace") == library.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("merges", ["aa aaa? ", "ab abab", "aa,aa aa,ab", "ab,ba,abba", "bb,abb,bba"])
def test_small_automata_equal_plain_merging(merges):
    """Every word of up to 7 letters, with merges that overlap themselves."""
    import itertools
    rules = {"aa aaa? ": [("a", "a"), ("aa", "a")], "ab abab": [("a", "b"), ("ab", "ab"), ("b", "a")],
             "aa,aa aa,ab": [("a", "a"), ("aa", "aa"), ("a", "b"), ("aa", "ab")],
             "ab,ba,abba": [("a", "b"), ("b", "a"), ("ab", "ba")],
             "bb,abb,bba": [("b", "b"), ("a", "bb"), ("bb", "a"), ("abb", "a")]}[merges]
    names = [chr(i) for i in range(256)]
    ids = {n: i for i, n in enumerate(names)}
    triples = []
    for a, b in rules:
        ids[a + b] = len(names)
        names.append(a + b)
        triples.append((ids[a], ids[b], ids[a + b]))
    v = byte_bpe.Vocabulary([n.encode("latin-1") for n in names], triples, list(range(256)))
    machine = bpe.compile_automaton(v)
    for n in range(1, 8):
        for word in itertools.product("ab", repeat=n):
            parts = list(word)
            for a, b in rules:
                i = 0
                while i < len(parts) - 1:
                    if (parts[i], parts[i + 1]) == (a, b):
                        parts[i:i + 2] = [a + b]
                    i += 1
            got = [names[t] for t in machine.path("".join(word).encode())]
            assert got == parts, "".join(word)


def test_compiling_holds_the_table_as_bits():
    """The driver compiles within a few times the size of the finished table."""
    import tracemalloc
    v = byte_bpe.read_vocabulary(VOCABULARY)
    tracemalloc.start()
    try:
        machine = bpe.compile_automaton(v)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(machine.allowed) < most < 3 * len(machine.allowed)


def test_queries_on_whole_table(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {i: digest(library, t) for i, t in docs.items()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_bpe_automaton"](spark, sf_dir).collect()}
    assert got == want
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_token_counts"](spark, sf_dir).collect()}
    assert got == {i: (len(t.encode()), want[i][0], want[i][0] > 512) for i, t in docs.items()}


def test_codec_round_trip_and_trouble(spark, trouble, clashing, make_docs):
    for docs in (trouble, clashing):
        rows = bpe.encode_documents(docs, VOCABULARY).collect()
        want = sorted(str((r.doc_id, r.text or "")) for r in docs.collect())
        assert sorted(str((r.doc_id, r.decoded)) for r in rows) == want
        assert len(token_count.token_counts(docs, VOCABULARY).collect()) == 10
    for run in (bpe.encode_documents, bpe.encode_digests, token_count.token_counts):
        assert run(make_docs([]), VOCABULARY).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("query,label,folds,held,floor", [("op6_quality_mil", "quality", 5, 0, 0.95),
                                                          ("op10_toxicity_nb", "toxic", 3, 1, 0.93)])
def test_held_out_accuracy(spark, query, label, folds, held, floor):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES[query](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in judged) / len(judged) >= floor


@pytest.mark.parametrize("op,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_trouble(spark, trouble, clashing, make_docs, op, label):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (7, 0), (8, 1), (8, 0), (9, 1), (None, 1), (6, None)],
                                   f"doc_id long, {label} int")
    for lab in (labels, labels.where("false"), labels.where(f"{label} = 1")):
        for docs in (trouble, clashing, make_docs([])):
            model = op.fit(docs, lab)
            rows = docs.select(op.score_column(docs, model).alias("p")).collect()
            assert len(rows) == docs.count() and all(0 <= r.p <= 1 for r in rows)


def test_sample_is_bounded_and_skips_the_held_out_fold(spark):
    from starbuild.llm.common import label_sample
    rows = [(i, i % 2) for i in range(5000)]
    got = label_sample(spark.createDataFrame(rows, "doc_id long, y int"), "y", 5, 0, 300).collect()
    assert len(got) == 300 and all(zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_long_texts_are_pooled_like_short_ones(monkeypatch):
    rng = np.random.default_rng(0)
    bags = [quality.passage_inputs([b"w%d" % j for j in rng.integers(0, 50, 300)]) for _ in range(20)]
    m = quality.fit_bags(bags, np.arange(20) % 2 * 1.0, epochs=2)
    text = " ".join(f"w{j}" for j in rng.integers(0, 50, 3000))
    whole = quality.score_text(m, text)
    monkeypatch.setattr(quality, "PIECE_WORDS", quality.PASSAGE_WORDS * 3)
    assert quality.score_text(m, text) == pytest.approx(whole, abs=1e-6)
    short = toxicity.ngram_buckets(text, 16)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.array_equal(toxicity.ngram_buckets(text, 16), short)


def test_quality_fit_sees_every_passage(spark, make_docs, monkeypatch):
    """Long documents keep all their passages, wherever the bad one is."""
    words = quality.PASSAGE_WORDS
    texts = ["good words " * (words // 2) * n for n in (1, 24, 25, 100, 300)]
    seen = []
    monkeypatch.setattr(quality, "fit_bags", lambda bags, y: seen.extend(map(len, bags)))
    labels = spark.createDataFrame([(i, 0) for i in range(len(texts))], "doc_id long, quality int")
    quality.fit(make_docs(list(enumerate(texts))), labels, folds=5, held=9)
    assert seen[:5] == [1, 24, 25, 100, 300]            # whole documents come before spans


def test_quality_fit_keeps_to_its_passages(spark, make_docs, monkeypatch):
    """Documents beyond the bound are left out whole; copies of a row count once."""
    words = quality.PASSAGE_WORDS
    texts = [f"t{i} " + "good words " * (words // 2) * n for i, n in enumerate((3, 3, 3, 200, 3, 3))]
    seen = []
    monkeypatch.setattr(quality, "fit_bags", lambda bags, y: seen.append(sorted(map(len, bags))))
    labels = spark.createDataFrame([(i, 0) for i in range(len(texts))], "doc_id long, quality int")
    docs = make_docs([*enumerate(texts), *[(0, texts[0])] * 50])
    for bound in (1000, 199, 8):
        quality.fit(docs, labels, folds=5, held=9, max_fit_passages=bound)
    whole = [[n for n in sizes if n > 1] for sizes in seen]
    assert whole == [[4] * 5 + [201], [4] * 5, [4, 4]]
    quality.fit(docs, labels, folds=5, held=9, max_fit_passages=3)
    assert seen[-1] == []


def test_quality_gradients_of_runs_equal_those_of_the_batch(monkeypatch):
    rng = np.random.default_rng(4)
    bags = [rng.random((n, quality.INPUTS)).astype(np.float32) for n in (3, 40, 1, 1, 25, 7, 100)]
    y = np.arange(7) % 2 * 1.0
    p = [rng.normal(0, 0.3, s) for s in ((quality.INPUTS, 8), 8, (8, 4), (8, 4), 4, 8, ())]
    whole = quality._gradients(p, bags, y)

    def loss(p):
        m, out = quality.QualityModel(*p), 0.0
        for x, label in zip(bags, y):
            top, total, sums = quality._pool(m, x, -np.inf, 0.0, np.zeros(8))
            out -= np.log(quality._sigmoid((2 * label - 1) * (sums / total @ m.out + m.out_bias)))
        return out / len(bags) + 0.5e-5 * (p[0] ** 2).sum()
    for i, a in enumerate(p):                           # against differences of the loss
        step = rng.normal(0, 1, np.shape(a))
        up, down = ([*p[:i], a + s * 1e-5 * step, *p[i + 1:]] for s in (1, -1))
        assert (loss(up) - loss(down)) / 2e-5 == pytest.approx((whole[i] * step).sum(), rel=1e-3, abs=1e-7)
    monkeypatch.setattr(quality, "FIT_PASSAGES", 10)
    for a, b in zip(whole, quality._gradients(p, bags, y)):
        np.testing.assert_allclose(a, b, rtol=1e-5, atol=1e-8)


def test_quality_fit_takes_short_spans_of_both_classes(spark, make_docs, monkeypatch):
    texts = [f"text {i} " + "and so on " * 30 for i in range(400)]
    seen = []
    monkeypatch.setattr(quality, "fit_bags", lambda bags, y: seen.extend(y.tolist()))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    quality.fit(make_docs(list(enumerate(texts))), labels, folds=5, held=9)
    good, bad = seen.count(1.0) - 200, seen.count(0.0) - 200
    assert 40 < good < 100 and 40 < bad < 100
