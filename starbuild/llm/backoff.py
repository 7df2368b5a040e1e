"""Language-model scores: stupid backoff, computed relationally.

1. Every word of a document ends one n-gram of each order up to ``order`` (fewer
   at the start of a text).  The n-grams are exploded into rows; an n-gram is
   the pair of its past (all but the last word) and its rest (all but the first
   word), each named by a 64-bit hash.  Texts are split once, into hashes of
   their words in the shared folder.
2. Their rows are counted (in the tasks that read the hashes, then by hash): the
   count tables of the corpus, partitioned by hash.  Of orders above 1 only
   n-grams seen ``min_count`` times or more are in the model.
3. A word's score is count(n-gram) / count(past) for the longest n-gram in the
   model that ends there, times ``discount`` for every order given up; of order
   1 it is the word's share of all words.  Longer n-grams replace shorter ones,
   so each n-gram of the tables gets a weight: the logarithm (base 10) of its own
   score less that of its rest.  A word's log score is then the sum of the
   weights of the n-grams of the model that end there (an n-gram of the model
   has its rest in the model, too).  The weights come from joins of the count
   tables with themselves.
4. The exploded n-grams are joined to the weights by hash and summed per
   document.

Orders are counted, weighed and joined one after the other, in ``PASSES`` ranges
of the n-grams' hashes; the result of each is written and its shuffle files go, so
the disk holds the rows of one pass, whatever the order.  Of a weight the counts
that it is made of are written, which take few bits each; the count tables of
n-grams above order 1 go when the weights are written.  Every row is one n-gram of
one document, whatever the size of the corpus; words
and n-grams that hold over a thousandth of all rows are salted in the join.

Edge cases: a null text counts as empty; a text without words has 0 words and
log score 0; repeated rows count in the corpus each and are scored each (rows
equal in id and text share one sum); null ids are allowed; an empty table gives
an empty result; extra columns are ignored.  Two n-grams of the same 64-bit
hash would share their counts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import freed, heavy_keys, spread_join, text_or_empty, written

BETWEEN = r"[\x20\x09-\x0D]+"
#: Rows above which a key is salted at all.
LEAST_HEAVY = 100_000
#: Equal rows that are returned by one task.
COPIES = 100_000
#: Passes over an order's n-grams, each over a range of their hashes: the disk
#: holds the shuffled rows of one pass at a time.
PASSES = 3
#: Bytes up to which Parquet names the words of a row group by number.
DICTIONARY = 16 << 20
#: Bytes of a row group of word hashes: its words by number then fit a core's
#: cache when a pass reads them.
ROW_GROUP = 4 << 20


def document_words(text: Column) -> Column:
    """The words of a text: parts between ASCII white space."""
    return F.array_remove(F.split(text, BETWEEN), "")


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with the hashes ``h`` of their words ``w``."""
    return rows if "h" in rows.columns else rows.withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).drop("w")


def grams_of_order(rows: DataFrame, k: int, passes: int = 1, part: int = 0) -> DataFrame:
    """``(doc, past, rest)`` of every n-gram of order ``k`` of ``rows`` (``doc``,
    words ``w`` or their hashes ``h``) in hash range ``part`` of ``passes``; of
    order 1 ``past`` is 0 and ``rest`` the word."""
    if k == 1:
        out = hashed(rows).select("doc", F.lit(0).cast("long").alias("past"), F.explode("h").alias("rest"))
    else:
        # a text of fewer than k words has no spots: its sequence would run down
        spots = (hashed(rows).where(F.size("h") >= k)
                 .select("doc", "h", F.explode(F.sequence(F.lit(k - 1), F.size("h") - 1)).alias("i")))
        grams = {back: F.get("h", F.col("i") - back) for back in range(k)}
        for shorter in range(2, k + 1):
            past, rest = grams[1], grams[0]
            grams = {back: gram_hash(F.lit(shorter), grams[back + 1], grams[back]) for back in range(k - shorter + 1)}
        out = spots.select("doc", past.alias("past"), rest.alias("rest"))
    if passes == 1:
        return out
    return out.where(F.pmod(gram_hash(F.lit(k), F.col("past"), F.col("rest")), F.lit(passes)) == part)


def exploded_grams(rows: DataFrame, order: int) -> DataFrame:
    """``(doc, k, past, rest)`` of every n-gram of every order."""
    parts = [grams_of_order(rows, k).withColumn("k", F.lit(k)) for k in range(1, order + 1)]
    return reduce(DataFrame.unionAll, parts).select("doc", "k", "past", "rest")


def gram_hash(k: Column, past: Column, rest: Column) -> Column:
    """The name of an n-gram: a word's own hash, else that of its two parts."""
    return F.when(k == 1, rest).otherwise(F.xxhash64(k, past, rest))


def count_tables(rows: DataFrame, order: int, min_count: int) -> DataFrame:
    """``(k, past, rest, n)``: the n-grams of the corpus that are in the model.

    Orders and passes are counted one after the other, each written."""
    tables = []
    for k in range(1, order + 1):
        passes = PASSES if k > 1 else 1
        for part in range(passes):
            counts = grams_of_order(rows, k, passes, part).groupBy("past", "rest").agg(F.count(F.lit(1)).alias("n"))
            counts = counts if k == 1 else counts.where(F.col("n") >= min_count)
            tables.append(written(counts, "grams", free_shuffles=True).select(F.lit(k).alias("k"), "past", "rest", "n"))
    return reduce(DataFrame.unionAll, tables)


def weights(counts: DataFrame, order: int, discount: float) -> DataFrame:
    """``(k, gram, weight, n)``: what every n-gram of the tables adds to a word's score.

    Passes are ranges of the pasts; written are counts (n-gram, past, rest and
    the rest's past), the logarithms are taken when they are read."""
    words = counts.where("k = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lost = math.log10(discount)

    def score(k: int, n: str, past_n: str) -> Column:
        return F.log10(n) - F.log10(past_n) + (order - k) * lost

    shorter = counts.where("k = 1").select(F.col("rest").alias("gram"), "n", F.lit(words or 1).cast("long").alias("past_n"))
    out = shorter.select(F.lit(1).alias("k"), "gram", score(1, "n", "past_n").alias("weight"), "n")
    for k in range(2, order + 1):
        rest = shorter.select(F.col("gram").alias("rest"), F.col("n").alias("rest_n"), F.col("past_n").alias("rest_past_n"))
        tables = []
        for part in range(PASSES):
            past = (shorter.where(F.pmod("gram", F.lit(PASSES)) == part)
                    .select(F.col("gram").alias("past"), F.col("n").alias("past_n")))
            mine = (counts.where((F.col("k") == k) & (F.pmod("past", F.lit(PASSES)) == part))
                    .select("past", "rest", "n"))
            # few rows of a table share a past or a rest that is hot: those of frequent words
            found = mine.join(past.hint("shuffle_hash"), "past").join(rest.hint("shuffle_hash"), "rest").select(
                gram_hash(F.lit(k), F.col("past"), F.col("rest")).alias("gram"), "n", "past_n", "rest_n", "rest_past_n")
            tables.append(written(found, "gram-weights", free_shuffles=True))
        found = reduce(DataFrame.unionAll, tables)
        weight = score(k, "n", "past_n") - score(k - 1, "rest_n", "rest_past_n")
        out = out.unionAll(found.select(F.lit(k).alias("k"), "gram", weight.alias("weight"), "n"))
        shorter = found.select("gram", "n", "past_n")
    return out


def weight_sums(rows: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``(doc, total)``: the weights of every text's n-grams, a row for each pass."""
    tables = []
    for k in range(1, order + 1):
        mine = model.where(F.col("k") == k).select("gram", "weight", "n")
        total = mine.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        heavy = heavy_keys(mine, "gram", "n", total, LEAST_HEAVY)
        for part in range(PASSES):
            grams = (grams_of_order(rows, k, PASSES, part)
                     .select("doc", gram_hash(F.lit(k), F.col("past"), F.col("rest")).alias("gram")))
            found = mine.where(F.pmod("gram", F.lit(PASSES)) == part).select("gram", "weight")
            # hashed, not sorted: a partition of the weights is small beside that of the n-grams
            joined = spread_join(grams, found.hint("shuffle_hash"), "gram", heavy, "inner")
            sums = joined.groupBy("doc").agg(F.sum("weight").alias("total"))
            tables.append(written(sums, "gram-sums", free_shuffles=True))
    return reduce(DataFrame.unionAll, tables)


def scores(documents: DataFrame, order: int = 3, discount: float = 0.4, min_count: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, log_score)`` of every row; the corpus is all rows."""
    text, ident = text_or_empty(text_col), F.col(id_col)
    rows = documents.select(ident.alias("id"), F.xxhash64(ident.isNull(), ident.cast("string"), text).alias("doc"),
                            document_words(text).alias("w"))
    # split once: every pass reads the hashes
    rows = written(hashed(rows), "word-hashes", free_shuffles=True,
                   options={"parquet.dictionary.page.size": DICTIONARY, "parquet.block.size": ROW_GROUP})
    counts = count_tables(rows, order, min_count)
    model = weights(counts, order, discount)
    # the weights hold these counts as well; those of words are read again
    freed(counts.where("k > 1"))
    sums = weight_sums(rows, model, order).groupBy("doc").agg(F.sum("total").alias("total"))
    # equal rows are counted, and told apart again at the end in runs that any task can take
    heads = rows.groupBy("doc", "id", F.size("h").cast("long").alias("n_words")).agg(F.count(F.lit(1)).alias("copies"))
    per_doc = heads.join(sums, "doc", "left").select(
        "id", "n_words", "copies", (F.coalesce("total", F.lit(0.0)) / F.col("copies")).alias("log_score"))
    runs = per_doc.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    left = F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("run") * COPIES)
    return (runs.repartition("id", "run").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
            .select("id", "n_words", "log_score"))
