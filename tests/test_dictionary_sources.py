import os

from starbuild.sources import dictionary as DI
from starbuild.sources import readers as R
from starbuild.sources import sinks as SK

# two names, two-line text, text with a second dash, label with '=',
# tab indentation, padded label.
DICT_A = """/* VISITYR - 4 digit year */
/* HOMECTRY & BIRTHCTRY - Country codes, valid and invalid ones,
   kept for processing */
/* FILEDT - Text date field - date the record was filed */
value ctryl
\t101 =  'NORTHLAND (sea and air ports only, no land crossings)'
   102 =  'SOUTHLAND'
\t'XYZ' = 'A = B'
   999 = '  PADDED  '

/* TRAVELMODE - Mode of travel */
value model
\t1 = 'Air'
\t2 = 'Sea'

"""

DICT_B = """/* INFLAG - Entry flag
   - admitted or passed through
   second line */
/* TALLY Used for summary statistics */
value portl
   'NPT'\t=\t'NORTH PORT, NL        '
"""


def _write(tmp_path):
    d = tmp_path / "dict"
    d.mkdir()
    (d / "a.sas").write_text(DICT_A)
    (d / "b.sas").write_text(DICT_B)
    return str(d)


def test_fields(spark, tmp_path):
    lines = DI.read_dictionary_lines(spark, _write(tmp_path))
    got = {r.field: r.description for r in DI.dictionary_fields(lines).collect()}
    assert got["visityr"] == "4 digit year"
    assert got["homectry"] == got["birthctry"] == \
        "Country codes, valid and invalid ones, kept for processing"
    assert got["filedt"] == "Text date field - date the record was filed"
    assert got["inflag"] == "Entry flag - admitted or passed through second line"
    assert got["tally"] == "Used for summary statistics"
    assert got["travelmode"] == "Mode of travel"


def test_codes(spark, tmp_path):
    lines = DI.read_dictionary_lines(spark, _write(tmp_path))
    got = {(r.list_name, r.code): r.label for r in DI.dictionary_codes(lines).collect()}
    assert got[("ctry", "101")] == "NORTHLAND (sea and air ports only, no land crossings)"
    assert got[("ctry", "102")] == "SOUTHLAND"
    assert got[("ctry", "XYZ")] == "A = B"
    assert got[("ctry", "999")] == "  PADDED  "
    assert got[("mode", "1")] == "Air" and got[("mode", "2")] == "Sea"
    assert got[("port", "NPT")] == "NORTH PORT, NL        "
    assert len(got) == 7


def test_csv_semicolon_and_schema(spark, tmp_path):
    p = tmp_path / "dem.csv"
    p.write_text("City;State Code;Median Age\nA;NY;31.5\nB;;x\n")
    raw = R.read_delimited(spark, str(p), sep=";")
    assert raw.columns == ["City", "State Code", "Median Age"]
    assert [f.dataType.simpleString() for f in raw.schema.fields] == ["string"] * 3
    typed = R.read_delimited(spark, str(p), sep=";",
                             schema="city string, state_code string, median_age double")
    rows = typed.collect()
    assert rows[0].median_age == 31.5 and rows[1].median_age is None


def test_partitioned_parquet_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b") for i in range(40)], "k int, p string")
    out = SK.write_parquet(df, str(tmp_path / "t"), partition_by=["p"])
    assert sorted(d for d in os.listdir(out) if d.startswith("p=")) == ["p=a", "p=b"]
    back = spark.read.parquet(out)
    assert back.filter("p = 'a'").count() == 30
    plan = back.filter("p = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_partitioned_parquet_range_cluster(spark, tmp_path):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b") for i in range(40)], "k int, p string")
    out = SK.write_parquet(df, str(tmp_path / "r"), partition_by=["p"], cluster="range")
    back = spark.read.parquet(out)
    assert sorted((r.k, r.p) for r in back.collect()) == sorted((r.k, r.p) for r in df.collect())


def test_write_tables(spark, tmp_path):
    t = {"x": spark.range(3), "y": spark.range(2)}
    paths = SK.write_tables(t, str(tmp_path))
    assert spark.read.parquet(paths["x"]).count() == 3


def test_dictionary_same_result_across_many_splits(spark, tmp_path):
    """Tiny input splits (a few lines each) must parse like whole files:
    comment and list state is carried across split boundaries."""
    path = _write(tmp_path)
    whole_f = sorted(DI.dictionary_fields(DI.read_dictionary_lines(spark, path)).collect())
    whole_c = sorted(DI.dictionary_codes(DI.read_dictionary_lines(spark, path)).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_open = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = DI.read_dictionary_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 10
        assert lines.select("file", "split").distinct().count() > 10
        assert sorted(DI.dictionary_fields(lines).collect()) == whole_f
        assert sorted(DI.dictionary_codes(DI.read_dictionary_lines(spark, path)).collect()) == whole_c
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", old_open)


def test_range_cluster_spreads_hot_partition_value(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.range(0, 30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise((F.col("id") % 50).cast("string")).alias("p"))
    # At this size AQE would coalesce all range partitions into one; turn
    # that off to look at the partitioning itself.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = SK.write_parquet(df, str(tmp_path / "w"), partition_by=["p"], cluster="range")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot_files = [f for f in os.listdir(os.path.join(out, "p=hot")) if f.endswith(".parquet")]
    assert len(hot_files) > 1                         # written by several tasks
    assert spark.read.parquet(out).filter("p = 'hot'").count() == 10000
