"""Staging-shaped inputs derived by Spark from the driver's tables.

The driver's tables are clean (no NULLs, typed dates); the operators exist
for dirty staging data.  These builders derive dirty variants with plain
expressions — a NULL injected with ``nullif``, dates rendered as text or day
counts, headers spelled like a CSV export — so every query still reads the
whole table and its work grows with it.  Each derivation is mirrored in the
oracle SQL of the same query key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.session import scratch_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with dates as ``date`` and a NULL flag where priority is 5-LOW."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"),
                    F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"))


def part_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows as roll-up input: money as decimal, a NULL mean for SMALL
    types and a NULL group for Brand#1."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.expr("nullif(p_brand, 'Brand#1')").alias("p_brand"),
        "p_type", "p_size",
        F.when(F.col("p_type") == "SMALL", F.lit(None))
         .otherwise(F.col("p_retailprice").cast("decimal(15,2)")).alias("p_retailprice"))


def customer_csv_headers() -> dict[str, str]:
    """Header spellings of a raw CSV export of ``customer``."""
    return {"c_custkey": " C-Custkey", "c_name": "C Name", "c_nationkey": "C_NATIONKEY ",
            "c_acctbal": "c-acctbal", "c_mktsegment": "C MktSegment"}


def write_customer_csv(spark: SparkSession, sf_dir: str, sep: str = ";") -> str:
    """Export ``customer`` as a header CSV with raw-style headers; returns the path."""
    path = scratch_path(spark, "customer-csv")
    heads = customer_csv_headers()
    c = table(spark, sf_dir, "customer")
    (c.select(*[F.col(k).alias(v) for k, v in heads.items()])
      .write.option("header", "true").option("sep", sep).csv(path))
    return path


def write_dictionary(spark: SparkSession, sf_dir: str, chunk: int = 500) -> str:
    """Write a label dictionary derived from ``part`` (field descriptions)
    and ``customer`` (code lists, one list per nation) as text files.

    Every block (a comment, or a code list chunk of at most ``chunk``
    codes with its own ``value`` header and closing blank line) lands
    whole in one file, lines in order, so files parse independently.  Some
    comments hold empty lines and lines that look like lists, some lists hold
    comments, and one comment (made from ``region``) never closes.
    """
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    single = F.concat(F.lit("/* P"), k, F.lit(" & Q"), k, F.lit(" - "), F.col("p_name"),
                      F.lit(" - "), F.col("p_type"), F.lit(" */"))
    double = F.concat(F.lit("/* P"), k, F.lit(" & Q"), k, F.lit(" - "), F.col("p_name"),
                      F.lit("\n\t"), F.col("p_type"), F.lit(" */"))
    # a comment whose lines look like an empty line, a list start and a code
    trap = F.concat(F.lit("/* P"), k, F.lit(" & Q"), k, F.lit(" - "), F.col("p_name"),
                    F.lit("\n\n\tvalue fakel\n\tA = '1'\n\t"), F.col("p_type"), F.lit(" */"))
    fields = p.select(F.concat(F.lit("f"), k).alias("block"), F.lit(0).alias("ord"),
                      F.when(F.col("p_size") > 45, trap).when(F.col("p_size") > 25, double)
                      .otherwise(single).alias("line"))

    c = table(spark, sf_dir, "customer")
    blk = F.concat(F.lit("c"), F.col("c_nationkey").cast("string"), F.lit("_"),
                   F.floor(F.col("c_custkey") / chunk).cast("string"))
    label = (F.when(F.col("c_acctbal") < 0,
                    F.concat(F.col("c_name"), F.lit(" = "), F.col("c_mktsegment")))
              .when(F.col("c_mktsegment") == "BUILDING",
                    F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
              .otherwise(F.col("c_name")))
    codes = c.select(blk.alias("block"), (F.col("c_custkey") + 1).alias("ord"),
                     F.concat(F.when(F.col("c_custkey") % 10 == 0, F.lit("/* note - x\n\nvalue innerl\n*/\n"))
                              .otherwise(F.lit("")),
                              F.lit("\t"), F.col("c_custkey").cast("string"), F.lit(" =  '"),
                              label, F.lit("'")).alias("line"))
    heads = c.select(blk.alias("block"), F.col("c_nationkey")).distinct().select(
        "block", F.lit(0).alias("ord"),
        F.concat(F.lit("value n"), F.col("c_nationkey").cast("string"), F.lit("_cityl"))
        .alias("line"))
    tails = heads.select("block", F.lit(2 ** 62).cast("long").alias("ord"), F.lit("").alias("line"))
    rows = (fields.select("block", F.col("ord").cast("long"), "line")
            .unionByName(codes.select("block", F.col("ord").cast("long"), "line"))
            .unionByName(heads.select("block", F.col("ord").cast("long"), "line"))
            .unionByName(tails))
    # a comment that never closes, the last block of its file ("~" sorts last)
    r = table(spark, sf_dir, "region").select(
        F.lit("~unclosed").alias("block"), (F.col("r_regionkey") + 1).cast("long").alias("ord"),
        F.concat(F.lit("value "), F.col("r_name")).alias("line"))
    first = r.groupBy("block").agg(F.lit(0).cast("long").alias("ord"),
                                   F.lit("/* lost - never closed").alias("line"))
    rows = rows.unionByName(r).unionByName(first)
    path = scratch_path(spark, "dictionary")
    (rows.repartition("block").sortWithinPartitions("block", "ord")
         .select("line").write.text(path))
    return path


#: Kinds of the columns of ``write_dirty_orders``.
DIRTY_KINDS = {"order_id": "bigint", "customer": "int", "price": "double", "ordered": "date:yyyyMMdd", "arrived": "epoch_day",
               "status": "string"}


def write_dirty_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as delimited lines, some of them bad: a text for a number, a date
    that does not exist, a required id left out, a field too many or too few; a
    header in every file, quoted separators, fractional integers."""
    path = scratch_path(spark, "dirty-orders")
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("string")
    fields = [F.when(k % 23 == 0, "").otherwise(k.cast("string")),
              F.when(k % 11 == 0, F.concat(F.lit("c"), "o_custkey")).when(k % 2 == 0, F.concat("o_custkey", F.lit(".0")))
              .otherwise(F.col("o_custkey").cast("string")),
              F.when(k % 13 == 0, "n/a").when(k % 17 == 0, "").otherwise(F.col("o_totalprice").cast("string")),
              F.when(k % 19 == 0, "20211332").otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
              F.concat(day, F.lit(".0")),
              F.concat(F.lit('"'), "o_orderstatus", F.lit(';x"'))]
    line = F.when(k % 29 == 0, F.concat_ws(";", *fields[:5])).when(k % 31 == 0, F.concat_ws(";", *fields, F.lit("more"))) \
            .otherwise(F.concat_ws(";", *fields))
    rows = o.repartition(4, "o_orderkey").select(F.spark_partition_id().alias("p"), line.alias("value"))
    header = spark.range(4).select(F.col("id").cast("int").alias("p"), F.lit("Order-ID;Customer;PRICE;ordered;Arrived;Status").alias("value"))
    rows.unionByName(header).select("value").write.text(path)
    return path
