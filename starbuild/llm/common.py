"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.session import ensure_checkpoint_dir, scratch_path

#: Java regular expression of a word: anything but the six ASCII white-space
#: characters (space, tab, line feed, vertical tab, form feed, return).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def text_or_empty(col: str | Column = "text") -> Column:
    """A null text counts as the empty text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"__{stem}_{uuid.uuid4().hex[:6]}"
    return name


#: Spark 4.1 and later: shuffle files go when the query that wrote them ends
#: (else when the driver happens to collect its garbage); earlier versions ignore it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free_shuffles: bool = False, options: dict | None = None) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` and
    read back: cuts the lineage and survives the loss of executors.  With
    ``free_shuffles`` the shuffle files of this one write are removed behind it;
    ``options`` go to the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    if free_shuffles:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        if free_shuffles and before is not None:
            spark.conf.set(FREE_SHUFFLES, before)
        elif free_shuffles:
            spark.conf.unset(FREE_SHUFFLES)
    return spark.read.schema(df.schema).parquet(path)


def freed(df: DataFrame) -> None:
    """Deletes the tables of :func:`written` that ``df`` reads; nothing may read them later."""
    spark = df.sparkSession
    for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fold(col: str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % folds


def label_sample(labels: DataFrame, label: str, folds: int, held: int, max_rows: int,
                 id_col: str = "doc_id") -> DataFrame:
    """At most ``max_rows`` labelled ids for fitting, as ``(id, y)``.

    Ids of fold ``held``, null ids and null labels are left out; repeated
    label rows collapse, and an id with contradicting labels is left out.
    The choice is by a hash of the id, so it does not depend on row order or
    partitioning.  The result is bounded by ``max_rows`` small rows.
    """
    rows = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
            .where(fold(id_col, folds) != held)
            .groupBy(F.col(id_col).alias("id"))
            .agg(F.min(label).alias("y"), F.max(label).alias("y_max"))
            .where("y = y_max").select("id", F.col("y").cast("int").alias("y")))
    total = rows.count()
    if total > max_rows:
        # a hash range slightly wider than needed keeps the final sort small
        share = min(1.0, 1.2 * max_rows / total + 100 / total)
        rows = rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    return rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(max_rows)


def heavy_keys(counts: DataFrame, key: str, n_col: str, total: int, least: int = 100_000) -> list:
    """Keys of ``counts`` that hold more than a thousandth of ``total`` rows
    (and more than ``least``): fewer than 1,000 values by construction."""
    bound = max(least, total // 1000)
    return [r[0] for r in counts.where(F.col(n_col) > bound).select(key).collect()]


def spread_join(left: DataFrame, right: DataFrame, key: str, heavy: list, how: str = "left",
                spread: int = 64) -> DataFrame:
    """Join ``left`` with ``right`` (at most one row per key) on ``key``.

    Rows of ``left`` whose key is in ``heavy``, or null in a left join, are
    spread over ``spread`` partitions by a hash of the row's other columns, and
    the few rows of ``right`` with heavy keys are repeated for each; so a key
    that holds a third of all rows is not one task's work."""
    if not heavy and how == "inner":
        return left.join(right, key, how)
    salt = fresh_name(left, "salt")
    others = [c for c in left.columns if c != key] or [key]
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    salted = left.withColumn(salt, F.when(is_heavy | F.col(key).isNull(),
                                          F.pmod(F.xxhash64(*others), F.lit(spread)).cast("int")).otherwise(F.lit(0)))
    # neither form is a constant: the optimizer would take a constant out of the shuffle keys
    if heavy:
        right = right.withColumn(salt, F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(spread - 1)))
                                                 .otherwise(F.array(F.lit(0)))))
    else:
        right = right.withColumn(salt, F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0)))
    return salted.join(right, [key, salt], how).drop(salt)
