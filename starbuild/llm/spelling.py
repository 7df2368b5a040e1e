"""Spelling variants: words one edit apart, by reduced-alphabet generation.

Letters are hashed to ``SYMBOLS`` symbols (code point modulo their number), so
a word becomes a reduced word and words one edit apart become reduced words at
most one edit apart.  The one-edit neighbourhoods of the distinct reduced words
are generated and joined to the reduced vocabulary; the pairs of words behind a
hit are verified on the original strings.  Of a pair of reduced words one side
generates the edit: a replacement is generated from the smaller symbol, and an
insertion into the shorter word is the deletion from the longer one.  So every
pair of the full neighbourhoods is found, once.

A reduced word that more than ``most`` words share would make the pairs behind
it a product of groups.  Words of such classes (and of the classes next to
them) are compared by keys of the original strings instead: each word with one
letter taken out, with its place (a replacement: both words have the key) and
without (an insertion: the key is the other word).  Only true pairs share them,
so that way is exact and as large as its result.

Word counts are added up in each task before they are shuffled; links of a word
are bounded by its length and the alphabet, chains of forms by the growth of
their counts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import checkpointed, text_or_empty, written

#: Letters and the symbols that they are hashed to.
FIRST, LAST = 0xC0, 0xFF
LETTERS = [chr(c) for c in (*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(FIRST, LAST + 1))]
SYMBOLS = 8
_DIGITS = "01234567"
#: Words of a class of one reduced word that are paired through it.
MOST = 256
#: Characters of a text that are read at once, and counts that a task holds.
PIECE, HELD = 1 << 20, 200_000

_RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_OTHER = re.compile(r"[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that end between words."""
    at = 0
    while len(text) - at > size:
        cut = _OTHER.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def run_counts(text: str) -> Counter:
    """How often each run of letters occurs, A-Z in lower case."""
    found: Counter = Counter()
    for piece in pieces(text):
        found.update(_RUN.findall(piece))
    out: Counter = Counter()
    for run, n in found.items():
        out[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return out


def thinned(run: str, doc_id: str, every: int) -> str:
    """The run, or (for one of ``every`` by the checksum of document and run)
    the run without one letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int, least_count: int, every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of the words with at least ``least_length`` letters that
    occur at least ``least_count`` times.  ``every`` thins runs (see ``thinned``)."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def frame() -> pd.DataFrame:
            return pd.DataFrame({"word": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                for run, n in run_counts(text).items():
                    if len(run) >= least_length:
                        word = thinned(run, doc_id, every) if every else run
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) > HELD:
                    yield frame()
                    held.clear()
        yield frame()

    return (rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def reduced(word: Column) -> Column:
    """The word in symbols."""
    return F.translate(word, "".join(LETTERS), "".join(_DIGITS[ord(c) % SYMBOLS] for c in LETTERS))


def neighbourhood(r: Column) -> Column:
    """The reduced word itself, with each one of its symbols taken out, and with
    each one replaced by each larger symbol (distinct strings)."""
    places = F.sequence(F.lit(1), F.length(r))

    def changed(symbol: str) -> Column:
        """The word with the symbol (or nothing) at each place."""
        return F.transform(places, lambda i: F.concat(F.substring(r, F.lit(1), i - 1), F.lit(symbol),
                                                      F.substring(r, i + 1, F.length(r))))

    def larger(symbol: str) -> Column:
        return F.filter(changed(symbol), lambda x: x > r)

    return F.array_distinct(F.concat(F.array(r), changed(""), *[larger(d) for d in _DIGITS[1:]]))


def _verified(pairs: DataFrame) -> DataFrame:
    """Pairs ``(a, b, ...)`` at one edit, each once."""
    return pairs.where("a != b").where(F.levenshtein("a", "b", 1) == 1)


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """``(a, na, b, nb)``: every pair of words of ``words`` (``word, n``, distinct)
    that one inserted, deleted or replaced code point turns into each other, once."""
    words = words.select("word", "n", F.xxhash64(reduced(F.col("word"))).alias("class"))
    classes = words.select(reduced(F.col("word")).alias("r")).groupBy("r").agg(F.count("*").alias("size"))
    # as many partitions as asked for: each row becomes dozens below
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = checkpointed(classes.withColumn("class", F.xxhash64("r")).repartition(parts, "class"))
    own = classes.select(F.col("class").alias("ca"), F.col("size").alias("sa"),
                         F.explode(neighbourhood(F.col("r"))).alias("near"))
    other = classes.select(F.col("class").alias("cb"), F.col("size").alias("sb"))
    hits = checkpointed(own.withColumn("cb", F.xxhash64("near")).drop("near").join(other, "cb").distinct())
    small = (F.col("sa") <= most) & (F.col("sb") <= most)
    a = words.select(F.col("class").alias("ca"), F.col("word").alias("a"), F.col("n").alias("na"))
    b = words.select(F.col("class").alias("cb"), F.col("word").alias("b"), F.col("n").alias("nb"))
    pairs = hits.where(small).select("ca", "cb").join(a, "ca").join(b, "cb")
    # inside one class both orders meet
    found = _verified(pairs.where((F.col("ca") != F.col("cb")) | (F.col("a") < F.col("b")))).select("a", "na", "b", "nb")
    large = hits.where(~small)
    touched = large.select(F.col("ca").alias("class")).union(large.select("cb")).distinct()
    hot = words.join(touched, "class", "left_semi").join(classes.select("class", "size"), "class")
    return found.unionByName(_pairs_by_letter(hot, most))


def _pairs_by_letter(words: DataFrame, most: int) -> DataFrame:
    """The pairs of ``words`` of which at least one is in a class of more than
    ``most`` words, by keys of the original strings."""
    word, places = F.col("word"), F.sequence(F.lit(1), F.length("word"))
    cut = F.transform(places, lambda i: F.struct(
        i.alias("place"), F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))).alias("rest")))
    keys = words.select("word", "n", "size", F.explode(cut).alias("k")).select("word", "n", "size", "k.*")
    left = keys.select("place", "rest", F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("sa"))
    right = keys.select("place", "rest", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"))
    replaced = left.join(right, ["place", "rest"]).where("a < b").drop("place", "rest")
    whole = words.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"))
    inserted = (left.drop("place").distinct().join(whole, F.col("rest") == F.col("b")).drop("rest"))
    return (replaced.unionByName(inserted).where((F.col("sa") > most) | (F.col("sb") > most))
            .select("a", "na", "b", "nb"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of every row of ``forms`` (``word, form``; each word once):
    the end of the chain of forms, the word itself without one.  Every round
    doubles the part of the chains that is done."""
    chain = checkpointed(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = checkpointed(chain.join(ahead, "root", "left")
                              .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        chain = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    return (forms.select("word").join(chain, "word", "left").select("word", F.coalesce("root", "word").alias("root")))


def variants(words: DataFrame, ratio: int = 10, most: int = MOST) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every row of ``words`` (``word, n``).

    ``form`` is the near word with the largest ``n`` (ties: the smallest in
    code-point order) if that is at least ``ratio`` times the word's own.

    Edge cases: an empty table gives an empty result; words without a near word
    have 0, nulls and themselves as root; words must be distinct and not null."""
    words = written(words.select("word", "n"), "spelling-words")
    pairs = checkpointed(near_pairs(words, most))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("m"))
    enough = -F.col("m.k") >= ratio * F.col("n")
    found = checkpointed(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("m.near")).alias("form"), F.when(enough, -F.col("m.k")).alias("form_n")))
    return found.join(roots(found), "word")


def spelling_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10,
                      every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all documents: runs of letters (A-Z, a-z and
    U+00C0 to U+00FF), A-Z in lower case.

    Edge cases: null, empty and blank texts have no words; texts are read in
    pieces, so memory grows with their distinct words; a null id counts as empty
    text; repeated rows count each; extra columns are ignored."""
    return variants(word_counts(docs, least_length, least_count, every, id_col, text_col), ratio)
