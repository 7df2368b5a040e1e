"""License scans: base phrases by plain search, planted and changed license texts."""
import re

import pytest

from starbuild.llm import license_scan as L

MIT = next(t for t in L.TEMPLATES if t.label == "mit" and not t.phrase)
BSD = next(t for t in L.TEMPLATES if t.label == "bsd" and not t.phrase)
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    words = words_of(text)
    hits = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def scan(df, **settings):
    return {r.id: r for r in L.license_scan(df, **settings).collect()}


def base_of(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


def test_base_phrases(make_docs):
    texts = ["MIT License, the mit-license and MIT\nLICENSE", "gnu lesser general public license; general public", "mit",
             "", None, "apacheé license apache license_mit license", "Kind mit lİcense mit license", "license mit"]
    got = scan(make_docs(list(enumerate(texts))))
    assert {i: base_of(r) for i, r in got.items()} == {i: base(t) for i, t in enumerate(texts)}
    assert got[1].labels == "gpl,lgpl" and got[2].labels == "" and got[2].score == 0 and got[0].score == 1


def test_license_texts(make_docs):
    filler = " ".join(f"word{i}" for i in range(300))
    mit = MIT.words
    changed = mit[:50] + ["and", "also", "this"] + mit[50:90] + mit[93:]        # three words in, three out
    halves = mit[:60] + [f"gap{i}" for i in range(200)] + mit[60:]
    twice = mit + ["between"] + mit
    docs = [(1, f"{filler} {MIT.text} {filler}"), (2, " ".join(changed)), (3, " ".join(mit[:40])), (4, " ".join(halves)),
            (5, " ".join(twice)), (6, BSD.text.upper()), (7, filler), (8, " ".join(reversed(mit)))]
    got = scan(make_docs(docs))
    assert {i: r.labels for i, r in got.items()} == {1: "mit", 2: "mit", 3: "", 4: "mit", 5: "mit", 6: "bsd", 7: "", 8: ""}
    assert got[1].score == got[5].score == got[6].score == 1.0 and 0.9 < got[2].score < 1
    assert got[1].n_base == 0 and got[1].base_labels == ""


def test_neighbouring_diagonals_are_needed(make_docs):
    """A word inserted every twenty: no single diagonal has enough of the template."""
    text = " ".join(w if i % 20 else f"{w} new{i}" for i, w in enumerate(MIT.words))
    docs = make_docs([(1, text)])
    assert scan(docs)[1].labels == "mit" and scan(docs, slack=0)[1].labels == ""


def test_rows_that_share_an_id(make_docs):
    docs = make_docs([(1, "mit license"), (1, "mit license"), (1, "apache license mit license"), (None, "mit license"),
                      (None, "mit license"), (None, None)])
    rows = sorted((str(r.id), r.n_words, r.n_base, r.labels) for r in L.license_scan(docs).collect())
    assert rows == sorted([("1", 2, 1, "mit"), ("1", 2, 1, "mit"), ("1", 4, 2, "apache,mit"), ("None", 2, 1, "mit"),
                           ("None", 2, 1, "mit"), ("None", 0, 0, "")])


def test_trouble_and_clashing_names(trouble, clashing):
    want = sorted((str(r.doc_id), *map(str, base(r.text))) for r in trouble.collect())
    for docs in (trouble, clashing):
        assert sorted((str(r.id), *map(str, base_of(r))) for r in L.license_scan(docs).collect()) == want


def test_empty_table(make_docs):
    assert L.license_scan(make_docs([])).count() == 0


def test_long_text_with_many_places(make_docs):
    row = scan(make_docs([(1, "mit license " * 50_000)]))[1]
    assert base_of(row) == (100_000, 50_000, 0, 99_998, "mit")


def test_main_path_is_native(spark, make_docs):
    plan = L.license_scan(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("t", L.TEMPLATES, ids=lambda t: f"{t.label}-{len(t.words)}")
def test_every_template_finds_itself(t):
    assert len(t.words) >= 2 and t.words == words_of(t.text)


def test_templates_find_their_labels(make_docs):
    got = scan(make_docs([(i, t.text) for i, t in enumerate(L.TEMPLATES)]))
    for i, t in enumerate(L.TEMPLATES):
        assert t.label in got[i].labels.split(",") and got[i].score == 1.0
