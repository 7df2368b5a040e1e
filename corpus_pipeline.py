"""Training-corpus pipeline over ``documents``.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the documents that stay (the last one: the encoded documents).
``run`` writes the result of every stage as Parquet to the shared folder and
reads it back as the next stage's input.

1. ``quality``: documents that the quality classifier rejects go.
2. ``toxicity``: documents that the toxicity classifier flags go.
3. ``simhash``: of each group of near-duplicates the document with the
   smallest id stays (one row of it); rows without an id come after all others.
4. ``mix``: sources are mixed to their target weights; a document stays as
   many times as the mix takes it, none to three times.
5. ``bpe``: token ids of every document of the mix, digested.

Edge cases of all stages: null texts count as empty, texts of any length are
read whole, extra columns are dropped, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbuild.llm import bpe, mixing, quality, simhash, toxicity
from starbuild.llm.common import fresh_name, table, text_or_empty, written
from starbuild.llm.queries import VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more stay; the model is
    learned from the labelled documents of this stage's input."""
    score = fresh_name(docs, "quality")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn(score, quality.score_column(docs, model)).where(f"{score} >= 0.3").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7 stay; the model is learned
    from the labelled documents of this stage's input."""
    score = fresh_name(docs, "toxicity")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn(score, toxicity.score_column(docs, model)).where(f"{score} < 0.7").select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest id (rows
    without an id come last), of those the first by text hash.

    Rows with the same id and different texts may be in different groups and
    stay for each."""
    docs = docs.select(*COLUMNS)
    found = simhash.near_duplicates(docs, words_per_shingle=3, reach=3, text_hash=True)
    key, number = fresh_name(docs, "key"), fresh_name(docs, "row")
    least = F.min(F.struct(F.col("id").isNull().alias("without"), "id", F.col("text_hash")))
    first = found.groupBy("root").agg(least.alias("r")).select(
        F.xxhash64("r.without", "r.id", "r.text_hash").alias(key))
    # one key for the join and the window: documents are shuffled once
    docs = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.xxhash64(text_or_empty("text"))))
    same_row = Window.partitionBy(key).orderBy("text", "lang", "source")
    return (docs.join(first, key, "left_semi")
            .withColumn(number, F.row_number().over(same_row)).where(f"{number} = 1").select(*COLUMNS))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: its taken words by its
    size, rounded up or down by a hash of the document (0 to 3 times)."""
    docs = docs.select(*COLUMNS)
    found = mixing.mix(docs)
    times = mixing.copies(F.col("taken"), F.col("size"), F.col("id"), F.col("text_hash"))
    # equal rows (same id and text) share their copies evenly
    found = (found.groupBy("id", "text_hash").agg(F.round(F.avg(times)).cast("int").alias("times"))
             .where("times > 0"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["id"])
                       & (F.xxhash64(text_or_empty(docs["text"])) == found["text_hash"]))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, digested; a document taken
    several times is a row for each time."""
    return bpe.encode_digests(docs, VOCABULARY)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("simhash", simhash_stage),
          ("mix", mix_stage), ("bpe", encode_stage)]

#: SQL cannot express learned scores, fingerprints, draws or merges; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
