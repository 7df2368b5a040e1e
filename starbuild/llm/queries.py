"""Registered queries of the numbered operators (``opN_<name>``) and their SQL.

Each query applies one operator with production parameters to its whole table
and derives the columns of its contract.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.llm import (backoff, bpe, embeddings, license_scan, mixing, periodic_runs, quality, rules, simhash,
                           spelling, token_count, toxicity, url_rules)
from starbuild.llm.common import fold, table

#: The contract's host rules (longest wins, tier 1); the block lists of junk
#: hosts and paths judge what no host rule fits.
URL_RULES = [url_rules.Rule("||net/", "block", 1), url_rules.Rule("||example.net/en/", "allow", 1),
             url_rules.Rule("||example.com/de/", "block", 1), url_rules.Rule("||org/fr/", "allow", 1),
             *url_rules.JUNK_RULES, *url_rules.JUNK_PATHS]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and risk-controlled cutoffs per language for every document."""
    found = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("lang"),
                         risk=0.02, delta=0.05)
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def op2_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram stupid-backoff score of every document under the whole corpus."""
    found = backoff.scores(table(spark, sf_dir, "documents"), order=3, discount=0.4, min_count=2)
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 4))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.round("log_score", 3).alias("log_score"),
                        mean.alias("mean_log_score"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heap-and-linked-list byte-pair token counts of every document."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of every document with the tokenization automaton."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op5_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, reach=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op6_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention-pooled quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"),
                        quality.score_column(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


def op7_embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of 0.98 or more."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host rules and block patterns for every page's URL."""
    found = url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)
    host_rule = F.when(F.col("tier") == 1, F.expr("substring(pattern, 3)"))
    return found.select("page_id", "host", "path", host_rule.alias("rule"), "verdict")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix by source weights 1, 2, 3, ... takes."""
    found = mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_toxicity_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character n-gram toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"),
                        toxicity.score_column(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of every word of all documents."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), least_length=7, least_count=2, ratio=10,
                                      every=31).select("word", "n", "n_near", "form", "form_n", "root")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in every document."""
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), change="crc32(cast(string(doc_id) as binary))")
    return found.withColumnRenamed("id", "doc_id").drop("n_dropped")


QUERIES = {
    "op1_quality_thresholds": op1_quality_thresholds,
    "op2_backoff_scores": op2_backoff_scores,
    "op3_token_counts": op3_token_counts,
    "op4_bpe_automaton": op4_bpe_automaton,
    "op5_simhash_vptree": op5_simhash_vptree,
    "op6_quality_mil": op6_quality_mil,
    "op7_embedding_cells": op7_embedding_cells,
    "op8_url_rules": op8_url_rules,
    "op9_source_mix": op9_source_mix,
    "op10_toxicity_nb": op10_toxicity_nb,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_license_scan": op12_license_scan,
    "op13_periodic_runs": op13_periodic_runs,
}


def _template_rows() -> str:
    """The license templates as SQL rows (number, label, phrase, base, words, k)."""
    return ",\n    ".join(f"({i}, '{t.label}', {t.phrase}, {t.base}, {t.words}, {t.gram})"
                          for i, t in enumerate(license_scan.TEMPLATES))


#: Learned scores, merges, automata, XXH64 fingerprints and hashed draws
#: (operators 3, 4, 5, 6, 9, 10) have no SQL, nor have the runs of operator 13
#: (quadratic in a text's words); their tests compare with brute force.
ORACLE: dict[str, str] = {
    "op1_quality_thresholds": r"""
with texts as (select doc_id, coalesce('s' || lang, 'n') as stratum, coalesce(text, '') as t from documents),
words as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from texts),
lines as (
    select doc_id, count(*) as n_lines, count(distinct line) as kinds
    from (select doc_id, unnest(string_split(t, chr(10))) as line from texts) x
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
runs as (
    select doc_id, i, count(*) over (partition by doc_id, run) as n
    from (select doc_id, i, ws[i:i + 4] as run
          from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from words) y) z),
repeats as (
    select doc_id, count(distinct spot) as n_repeat_words
    from (select doc_id, unnest(range(i, i + 5)) as spot from runs where n > 1) x group by doc_id),
base as (
    select w.doc_id, w.stratum, len(w.ws) as n_words,
           length(regexp_replace(w.t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
           length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) as n_symbols,
           coalesce(l.n_lines - l.kinds, 0) as n_dup_lines, coalesce(r.n_repeat_words, 0) as n_repeat_words,
           coalesce(l.n_lines, 0) as n_lines, length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g')) as n_capitals
    from words w left join lines l on l.doc_id = w.doc_id left join repeats r on r.doc_id = w.doc_id),
judged as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
           [case when n_words > 0 then n_symbols * 1000 // n_words else 0 end,
            case when word_chars > 0 then n_capitals * 1000 // word_chars else 0 end,
            case when n_lines > 0 then n_dup_lines * 1000 // n_lines else 0 end,
            case when n_words > 0 then n_repeat_words * 1000 // n_words else 0 end] as measure
    from base),
good as (
    select j.* from judged j join labels l on l.doc_id = j.doc_id where l.quality = 1 and not j.base_failed),
tries as (
    select stratum, rule, cutoff, count(*) as n, count(*) filter (where measure[rule] > cutoff) as k
    from good, unnest(range(1, 5)) r(rule),
         unnest([5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000]) c(cutoff)
    group by all),
tails as (
    select stratum, rule, cutoff, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                                          + i * ln(0.005) + (n - i) * ln(0.995))) as p
    from (select *, unnest(range(0, k + 1)) as i from tries) x group by all),
passed as (
    select *, bool_and(p <= 0.05 / ((select count(distinct stratum) from texts) * 4))
                over (partition by stratum, rule order by cutoff desc) as certified
    from tails),
cuts as (select stratum, rule, min(cutoff) as cutoff from passed where certified group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not exists (select 1 from cuts c where c.stratum = j.stratum and j.measure[c.rule] > c.cutoff)
         as kept
from judged j
""",
    "op7_embedding_cells": r"""
with recursive vectors as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as x, b.vec_id as y from vectors a join vectors b
      on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
     and list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) as (
    select vec_id, vec_id from embeddings
    union select r.x, l.y from reach r join links l on l.x = r.y),
least as (select x, min(y) as component_id from reach group by x),
degree as (select x, count(*) as n_links from links group by x)
select e.vec_id, coalesce(d.n_links, 0) as n_links, t.component_id, e.vec_id = t.component_id as kept
from embeddings e join least t on t.x = e.vec_id left join degree d on d.x = e.vec_id
""",
    "op2_backoff_scores": r"""
with texts as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
    from documents),
spots as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from texts),
grams as (
    select doc_id, ws[i] as w, case when i > 1 then ws[i - 1] end as v, case when i > 2 then ws[i - 2] end as u
    from spots),
c1 as (select w, count(*) as c from grams group by all),
c2 as (select v, w, count(*) as c from grams where v is not null group by all),
c3 as (select u, v, w, count(*) as c from grams where u is not null group by all),
sums as (
    select g.doc_id, sum(log10(case when c3.c >= 2 then c3.c / past2.c when c2.c >= 2 then 0.4 * c2.c / past1.c
                                    else 0.4 * 0.4 * c1.c / (select sum(c) from c1) end)) as s
    from grams g join c1 on c1.w = g.w
    left join c2 on c2.v = g.v and c2.w = g.w
    left join c3 on c3.u = g.u and c3.v = g.v and c3.w = g.w
    left join c2 past2 on past2.v = g.u and past2.w = g.v
    left join c1 past1 on past1.w = g.v
    group by all)
select t.doc_id, len(t.ws) as n_words, round(coalesce(s.s, 0), 3) as log_score,
       case when len(t.ws) > 0 then round(s.s / len(t.ws), 4) end as mean_log_score
from texts t left join sums s on s.doc_id = t.doc_id
""",
    "op8_url_rules": r"""
with parts as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages),
forms as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path
    from parts),
rules(h, p, name, action) as (values ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
    ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
hits as (
    select f.page_id, f.host, f.path, max_by(r.name, length(r.name)) as rule, max_by(r.action, length(r.name)) as action
    from forms f left join rules r on (f.host = r.h or ends_with(f.host, '.' || r.h)) and starts_with(f.path, r.p)
    group by all)
select h.page_id, h.host, h.path, h.rule,
       coalesce(h.action, case when regexp_matches(h.host, '(^|[.-])(' || j.words || ')([^0-9A-Za-z]|$)')
                                or regexp_matches(h.host || h.path, '/(wp-login\.php|wp-admin/|xmlrpc\.php|phpmyadmin/|cgi-bin/|\.git/)')
                                or regexp_matches(h.host || h.path, '/\.env([^0-9A-Za-z]|$)|/ads/.*\.html([^0-9A-Za-z]|$)')
                               then 'block' else 'allow' end) as verdict
from pages g join hits h using (page_id),
     (select '""" + "|".join(w for words in url_rules.JUNK_WORDS.values() for w in words) + r"""' as words) j
""",
    "op11_spelling_variants": r"""
with recursive bits as (
    select [list_reduce(list_prepend(x, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
            for x in range(256)] as crc),
runs as (
    select doc_id, run, count(*) as n
    from (select coalesce(doc_id::varchar, '') as doc_id,
                 translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as run from documents) x
    where length(run) >= 7 group by all),
sums as (
    select run, n, xor(list_reduce(list_prepend(4294967295, [('0x' || substr(code, i, 2))::bigint for i in range(1, length(code), 2)]),
                                   lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as h
    from (select run, n, hex(encode(doc_id || ':' || run)) as code from runs) x, bits),
words as (
    select word, sum(n)::bigint as n
    from (select n, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                         else run end as word from sums) x
    where length(word) >= 7 group by all having sum(n) >= 2),
cuts as (
    select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words) x),
pairs as (
    select a.word, a.n, b.word as near, b.n as near_n from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select a.word, a.n, b.word, b.n from cuts a join words b on a.rest = b.word
    union select b.word, b.n, a.word, a.n from cuts a join words b on a.rest = b.word),
best as (
    select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by all),
found as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * w.n then near end as form,
           case when near_n >= 10 * w.n then near_n end as form_n
    from words w left join best b on b.word = w.word),
chain(word, root, form) as (
    select word, word, form from found
    union all select c.word, f.word, f.form from chain c join found f on f.word = c.form)
select f.word, f.n, f.n_near, f.form, f.form_n, c.root
from found f join chain c on c.word = f.word and c.form is null
""",
    "op12_license_scan": r"""
with texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from documents),
templates(template, label, phrase, base, words, k) as (values
    """ + _template_rows() + r"""),
grams as (
    select template, label, phrase, base, k, len(words) as size, i - 1 as place, words[i:i + k - 1] as gram
    from (select *, unnest(range(1, len(words) - k + 2)) as i from templates) x),
spots as (select doc_id, ws, unnest(range(1, len(ws))) as i from texts),
votes as (
    select doc_id, i - 1 as pos, g.* from spots s
    join grams g on g.gram[1] = ws[i] and g.gram[2] = ws[i + 1] and g.gram = ws[i:i + k - 1]),
lines as (
    select *, case when diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) > 8 then 1 else 0 end as apart
    from (select doc_id, template, size, k, pos - place as diagonal, list(pos) as spots from votes where not phrase group by all) x),
bands as (
    select doc_id, template, size, k, diagonal, spots,
           sum(apart) over (partition by doc_id, template order by diagonal rows unbounded preceding) as band from lines),
spans as (
    select doc_id, template, size, count(distinct spot - diagonal) as spots, max(spot) - min(spot) + 1 as width,
           count(distinct spot) as dense
    from (select doc_id, template, size, band, diagonal, unnest(flatten([range(p, p + k) for p in spots])) as spot from bands) x
    group by doc_id, template, size, band),
labels as (
    select doc_id, label, 1.0::double as score, base, pos from votes where phrase
    union all
    select doc_id, label, spots / size, false, null from spans join templates using (template)
    where spots / size >= 0.6 and dense / width >= 0.5)
select t.doc_id, len(t.ws) as n_words, count(l.pos) filter (where base) as n_base, min(l.pos) filter (where base) as first_word,
       max(l.pos) filter (where base) as last_word,
       coalesce(string_agg(distinct label, ',' order by label) filter (where base), '') as base_labels,
       coalesce(string_agg(distinct label, ',' order by label), '') as labels, coalesce(max(score), 0.0) as score
from texts t left join labels l on l.doc_id = t.doc_id group by t.doc_id, t.ws
""",
}
