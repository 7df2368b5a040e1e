"""Every pipeline stage on its own input, against brute force."""
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starbuild.llm import quality, toxicity
from starbuild.llm.common import written
from tests_llm_helpers import digest, slow_fingerprint, slow_groups, slow_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def test_columns_and_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "simhash", "mix", "bpe"]
    for df in stages[:-1]:
        assert df.columns == corpus_pipeline.COLUMNS


def test_classifier_stages(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for i, (op, sign) in enumerate([(quality, 1), (toxicity, -1)]):
        before, after = stages[i], stages[i + 1]
        model = op.fit(before, labels)
        score = op.score_text if op is quality else (
            lambda m, t: op.score_buckets(m, op.ngram_buckets(t, m.bits)))
        want = sorted(r.doc_id for r in before.collect()
                      if (score(model, r.text or "") >= 0.3 if sign > 0 else score(model, r.text or "") < 0.7))
        assert sorted(r.doc_id for r in after.collect()) == want
        assert 0 < len(want) <= before.count()


def test_simhash_stage(stages):
    rows = stages[2].collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in rows]
    assert {r.doc_id for r in stages[3].collect()} == set(slow_groups(prints, 3))
    assert stages[3].count() == len({r.doc_id for r in stages[3].collect()})


def test_simhash_stage_keeps_one_row_of_each_group(spark, sf_dir, make_docs):
    """A repeated id with a copy of another document and a text of its own, in
    both orders of the text hash."""
    a, b = (" ".join(f"{w}{i * i % 97}" for i in range(60)) for w in ("left", "right"))
    for copied, own in ((a, b), (b, a)):
        docs = make_docs([(5, copied), (5, own), (3, copied + " "), (5, own), (3, copied + " ")])
        kept = [(r.doc_id, r.text) for r in corpus_pipeline.simhash_stage(spark, docs, sf_dir).collect()]
        assert sorted(kept) == [(3, copied + " "), (5, own)]


def test_mix_stage(stages):
    size, of, texts = Counter(), {}, {}
    for r in stages[3].collect():
        size[r.source] += len(WORD.findall(r.text or ""))
        of[r.doc_id], texts[r.doc_id] = r.source, r.text
    taken, times = Counter(), Counter()
    for r in stages[4].collect():
        assert texts[r.doc_id] == r.text
        taken[r.source] += len(WORD.findall(r.text or ""))
        times[r.doc_id] += 1
    assert max(times.values()) <= 3
    target = slow_targets(dict(size))
    assert abs(sum(taken.values()) - sum(size.values())) <= 0.15 * sum(size.values())
    light = sum(taken[s] for s in size if target[s] < size[s])
    assert abs(light - sum(t for s, t in target.items() if t < size[s])) <= 0.35 * light


def test_bpe_stage(stages):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, *digest(tok, r.text or "")) for r in stages[4].collect())
    assert Counter(map(tuple, stages[5].collect())) == want


def test_trouble(spark, clashing, sf_dir, make_docs):
    for docs in (clashing, make_docs([])):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= 3 * n
        assert stage_rows(spark, docs, sf_dir) == n
    kept = corpus_pipeline.simhash_stage(spark, clashing, sf_dir).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "5", "6", "7", "8", "9"]


def test_simhash_stage_without_ids(spark, sf_dir, make_docs):
    """One row of a group of rows without ids; of a mixed group the one with an id."""
    a, b, c = (" ".join(f"{w}{i * i % 97}" for i in range(60)) for w in ("left", "right", "down"))
    docs = make_docs([(None, a), (None, a), (None, a + " "), (None, b), (9, b), (9, c), (None, c)])
    kept = [(r.doc_id, r.text.strip()) for r in corpus_pipeline.simhash_stage(spark, docs, sf_dir).collect()]
    assert sorted(kept, key=str) == sorted([(None, a), (9, b), (9, c)], key=str)


def stage_rows(spark, docs, sf_dir):
    return corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).where(F.col("n_tokens") >= 0).count()
