"""Mixing sources to target weights, with DataFrame operations only.

1. Sizes: words of every document; a source's target is its share by weight
   of all words, at most ``most`` times its own words, the excess shared by
   weight among the others until no source is above.
2. Packing: the words of a source form streams (one per hash bucket of its
   documents), cut into blocks of ``block_words`` words; blocks are numbered
   through the source.
3. Draw: the output is dealt in shards of ``shard_blocks`` slots.  A shard's
   counts of slots per source are drawn multinomially: the whole parts of the
   expected counts are set, and the remaining slots are drawn with the
   probabilities of the fractional parts, so that small runs stay near their
   targets as well.
4. Slots: the slots of a source are numbered through all shards.  Slot j
   takes the block that a pseudorandom permutation of the source's block
   numbers (swap-or-not rounds) gives for j modulo the number of blocks; a
   block comes again only when all have come, and no block more than ``most``
   times.
5. Blocks are joined by index with the documents that they hold.

All random choices are hashes of a seed and of ids, so reruns agree.  Two
tables have one row per source and per (source, shard); the running sums over
them are the only ones that gather a source's rows in one task.

Edge cases: a null text has size 0, is never taken, and its row is returned; a
null source is a source of its own, after all others; a source without words
has target 0; repeated rows are separate documents; null ids are allowed; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import WORD_PATTERN, checkpointed, heavy_keys, spread_join, text_or_empty, written
from starbuild.operators.sequence import with_sequence_id

#: Rounds of the permutation, documents per packing bucket, slots made by one row.
ROUNDS, BUCKET_DOCS, CHUNK = 24, 2000, 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def permuted(x: Column, n: Column, keys: Column) -> Column:
    """Image of ``x`` under a permutation of 0 .. n-1: in each round x and its
    mirror ``key - x`` change places if a hash bit of the pair says so."""
    def turn(at: Column, key: Column) -> Column:
        mirror = F.pmod(key - at, n)
        return F.when(F.xxhash64(F.greatest(at, mirror), key) % 2 == 0, mirror).otherwise(at)

    return F.aggregate(keys, x, turn)


def _targets(sources: DataFrame, total: int, most: int) -> DataFrame:
    """Add ``target``: weights shared out up to ``most`` times the size."""
    level, capped = 0.0, -1
    while total:
        over = F.col("weight") * F.lit(level) >= F.col("source_size") * most
        row = sources.agg(F.count_if(over).alias("n"),
                          F.sum(F.when(over, F.col("source_size") * most).otherwise(0)).alias("held"),
                          F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight")).first()
        if row.n == capped or not row.weight:
            break
        capped, level = row.n, (total - row.held) / row.weight
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)),
                                                (F.col("source_size") * most).cast("double")))


def mix(documents: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, block_words: int = 64,
        shard_blocks: int = 1 << 16, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``(id, text_hash, size, source_size, target, taken)`` per row."""
    text = text_or_empty(text_col)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    sizes = written(documents.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                                     key.alias("key"), word_count(text).alias("size")), "mix-sizes")
    totals = sizes.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    # the names sort by code point, the null source ("n") after all others ("s...")
    order = F.when(F.col("key") == "n", None).otherwise(F.col("key")).asc_nulls_last()
    sources = with_sequence_id(totals, [order], "s")
    sources = checkpointed(sources.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int"))))
    total, n_docs = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)),
                                F.coalesce(F.sum("docs"), F.lit(0))).first()
    sources = _targets(sources, total, most)

    # a source has as many buckets as its documents need, so all are about equal
    buckets = F.greatest(F.ceil(F.col("docs") / BUCKET_DOCS), F.lit(1)).cast("long").alias("buckets")
    rows = spread_join(sizes, sources.select("key", "s", "source_size", "target", buckets), "key",
                       heavy_keys(sources, "key", "docs", n_docs), "inner").drop("key")
    stream = Window.partitionBy("s", "bucket").orderBy("text_hash", "id", "size")
    packed = (rows.where("size > 0")
              .withColumn("bucket", F.pmod(F.xxhash64("id", "text_hash", F.lit(seed)), F.col("buckets")).cast("int")).drop("buckets")
              .withColumn("end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0))))
    packed = written(packed, "mix-packed")
    made = packed.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    made = made.withColumn("blocks", F.ceil(F.col("words") / block_words).cast("long"))
    by_source = Window.partitionBy("s").orderBy("bucket")
    made = checkpointed(made.withColumn(
        "first", F.sum("blocks").over(by_source.rowsBetween(Window.unboundedPreceding, 0)) - F.col("blocks")))
    sources = sources.join(made.groupBy("s").agg(F.sum("blocks").alias("blocks")), "s")
    # slots wanted: the target in blocks of the source's mean length
    sources = checkpointed(sources.withColumn("want", F.col("target") * F.col("blocks") / F.col("source_size")))

    taken = _drawn_blocks(sources, most, shard_blocks, seed)
    pieces = packed.join(made.select("s", "bucket", "first"), ["s", "bucket"])
    begin = F.col("end") - F.col("size")
    pieces = pieces.withColumn("b", F.explode(F.sequence(F.floor(begin / block_words),
                                                         F.floor((F.col("end") - 1) / block_words))))
    pieces = pieces.withColumn("words", F.least("end", (F.col("b") + 1) * block_words)
                               - F.greatest(begin, F.col("b") * block_words))
    met = pieces.withColumn("block", F.col("first") + F.col("b")).join(taken, ["s", "block"], "left")
    out = (met.groupBy("s", "bucket", "end", "id", "text_hash", "size", "source_size", "target")
           .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))
    columns = ["id", "text_hash", "size", "source_size", "target"]
    return out.select(*columns, "taken").unionByName(
        rows.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))


def _drawn_blocks(sources: DataFrame, most: int, shard_blocks: int, seed: int) -> DataFrame:
    """``(s, block, times)``: how often the output takes each block."""
    wanted = sources.agg(F.sum("want")).first()[0] or 0.0
    slots = int(round(wanted))
    shards, tail = max(1, -(-slots // shard_blocks)), slots % shard_blocks or min(slots, shard_blocks)
    # kinds of shards: full ones (0) and the last one (1)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(float(n)).alias("n"))
                                for k, n in ((0, shard_blocks), (1, tail))]))
    plan = (sources.where("want > 0").select("s", "want", kinds.alias("k")).select("s", "want", "k.*")
            .withColumn("mean", F.col("want") / F.lit(wanted or 1.0) * F.col("n"))
            .withColumn("whole", F.floor("mean")).withColumn("part", F.col("mean") - F.col("whole"))
            .withColumn("to", F.sum("part").over(Window.partitionBy("kind").orderBy("s")
                                                 .rowsBetween(Window.unboundedPreceding, 0))))
    plan = checkpointed(plan)
    left = {r.kind: (int(round(r.n - r.w)), r.p) for r in
            plan.groupBy("kind").agg(F.max("n").alias("n"), F.sum("whole").alias("w"), F.sum("part").alias("p")).collect()}
    of_kind = F.when(F.col("kind") == 1, F.array(F.lit(shards - 1).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.lit(shards - 2).cast("long")) if shards > 1 else F.array().cast("array<long>"))
    counts = plan.select("s", F.explode(of_kind).alias("shard"), F.col("whole").alias("c"))
    # the remaining slots: point u on the line of fractional parts, met through its unit cell
    spark = sources.sparkSession
    draws = spark.range(shards).withColumnRenamed("id", "shard").withColumn(
        "kind", (F.col("shard") == shards - 1).cast("int"))
    n_left = F.when(F.col("kind") == 1, F.lit(left.get(1, (0, 0))[0])).otherwise(F.lit(left.get(0, (0, 0))[0]))
    length = F.when(F.col("kind") == 1, F.lit(float(left.get(1, (0, 0))[1]))).otherwise(F.lit(float(left.get(0, (0, 0))[1])))
    draws = (draws.where(n_left > 0)
             .withColumn("i", F.explode(F.sequence(F.lit(1), n_left)))
             .withColumn("u", F.pmod(F.xxhash64("shard", "i", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52)) * length)
             .withColumn("cell", F.floor("u")))
    line = plan.where("part > 0").withColumn("from", F.col("to") - F.col("part")).select(
        "s", "kind", "from", "to", F.explode(F.sequence(F.floor("from"), F.floor("to"))).alias("cell"))
    drawn = (draws.join(line, ["kind", "cell"]).where("u >= `from` and u < `to`")
             .select("s", "shard", F.lit(1).cast("long").alias("c")))
    counts = counts.unionByName(drawn).groupBy("s", "shard").agg(F.sum("c").alias("c"))
    numbered = counts.withColumn("j", F.sum("c").over(
        Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"))
    # chunks of slots are spread over the cluster before they are written out; a
    # stated number of partitions is not merged again for the rows being few
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (numbered.where("c > 0")
                .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(CHUNK).cast("long"))))
                .select("s", (F.col("j") + F.col("at")).alias("j"),
                        F.least(F.col("c") - F.col("at"), F.lit(CHUNK)).alias("c"))
                .join(sources.select("s", "blocks"), "s")
                .withColumn("keys", F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.pmod(
                    F.xxhash64(F.col("s"), r, F.lit(seed)), F.col("blocks"))))
                .repartition(parts, "s", "j"))
    slot = (numbered.withColumn("slot", F.explode(F.sequence(F.col("j"), F.col("j") + F.col("c") - 1)))
            .where(F.col("slot") < F.col("blocks") * most)
            .withColumn("start", F.pmod(F.col("slot") + F.pmod(F.xxhash64(
                F.col("s"), F.floor(F.col("slot") / F.col("blocks")), F.lit(seed)), F.col("blocks")), F.col("blocks"))))
    return (slot.select("s", permuted(F.col("start"), F.col("blocks"), F.col("keys")).alias("block"))
            .groupBy("s", "block").agg(F.count("*").alias("times")))


def copies(taken: Column, size: Column, *by: Column) -> Column:
    """Whole copies of a document that stand for its taken words: the ratio
    rounded up or down by a hash of the document, so that sums keep to it."""
    u = F.pmod(F.xxhash64(*by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.when(size > 0, F.floor(taken / size + u)).otherwise(F.lit(0)).cast("int")
