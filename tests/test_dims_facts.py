import re

import pytest
import datetime as dt

from pyspark.sql import functions as F

from starbuild.operators import aggregates as A
from starbuild.operators import dims as D
from starbuild.operators import facts as FT
from starbuild.operators.joins import hot_of_counts
from starbuild.operators.sequence import with_sequence_id

FLAGS = ["entdepa", "entdepd", "entdepu", "matflag"]

# arrivals staging fixture — a null in each flag, a null key, null dates,
# a malformed dtaddto, a fractional day count and a repeated flag combination.
ARRIVALS = [
    (1.0, "G", "O", None, "M", 20573.0, 20580.0, "05012016"),
    (2.0, "G", "O", None, "M", 20574.5, None, "D/S"),
    (3.0, None, "O", "U", "M", 20573.0, 20590.0, "05022016"),
    (4.0, "T", None, "U", "M", None, 20575.0, "05032016"),
    (5.0, "T", "R", "U", None, 20576.0, 20577.0, "05032016"),
    (None, "T", "R", "U", "M", 20576.0, 20577.0, "05042016"),
    (7.0, "T", "R", "U", "M", 20576.0, 20577.0, "05042016"),
    (8.0, "T", "R", "U", "M", 20577.0, 20578.0, "05052016"),
    (9.0, "A", "K", "U", "M", 20578.0, 20579.0, "05052016"),
]
SCHEMA = ("cicid double, entdepa string, entdepd string, entdepu string, matflag string, "
          "arrdate double, depdate double, dtaddto string")


def staged(spark):
    from starbuild.plans.star import StagingSpec, stage
    df = spark.createDataFrame(ARRIVALS, SCHEMA)
    return stage(df, StagingSpec(int_columns=["cicid"], epoch_day_columns=["arrdate", "depdate"],
                                 pattern_dates={"dtaddto": "MMddyyyy"}, required=["cicid"]))


def test_combination_dimension_keys_are_ranks(spark):
    dim = D.combination_dimension(staged(spark), FLAGS)
    rows = sorted((r.status_flag_id, tuple(r[f] for f in FLAGS)) for r in dim.collect())
    assert rows == [(0, ("A", "K", "U", "M")), (1, ("T", "R", "U", "M"))]


def test_sequence_ids_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    a = {r.k: r.sid for r in with_sequence_id(df, ["k"], "sid", num_partitions=3).collect()}
    b = {r.k: r.sid for r in with_sequence_id(df.repartition(11), ["k"], "sid",
                                              num_partitions=17).collect()}
    assert a == b == {k: k for k in range(5000)}


def test_fact_join_null_flags_get_null_key(spark):
    s = staged(spark)
    dim = D.combination_dimension(s, FLAGS)
    fact = FT.attach_dimension_key(s, dim, FLAGS, "status_flag_id")
    got = {r.cicid: r.status_flag_id for r in fact.collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: None, 7: 1, 8: 1, 9: 0}
    assert fact.count() == s.count() == 8


def test_fact_join_is_broadcast_by_bytes(spark):
    s = staged(spark)
    dim = D.combination_dimension(s, FLAGS).checkpoint(eager=True)
    fact = FT.attach_dimension_key(s, dim, FLAGS, "status_flag_id", salt_by=["cicid"])
    qe = fact._jdf.queryExecution()
    qe.toRdd().count()
    final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


@pytest.mark.parametrize("hot", [False, True])
def test_fact_join_one_contract_for_every_size(spark, hot):
    """A map column, NULL flags and a combination with a third of the rows:
    equal rows with and without broadcast, hot keys spread or not."""
    n = 3000
    base = spark.range(n).select(
        "id", F.create_map(F.lit("k"), F.col("id")).alias("m"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, (F.col("id") % 40).cast("string")).alias("a"),
        F.when(F.col("id") % 5 == 0, F.lit(None).cast("string")).otherwise("x").alias("b"))
    combos = D.flag_combinations(base, ["a", "b"]).checkpoint()
    dim = D.rank_combinations(combos, ["a", "b"], "k").checkpoint()
    keys = hot_of_counts(combos, ["a", "b"], "rows", least=100) if hot else []
    assert len(keys) == (1 if hot else 0)
    rows = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            fact = FT.attach_dimension_key(base, dim, ["a", "b"], "k", salt_by=["id"], hot=keys, salt_buckets=8)
            assert fact.columns == ["id", "m", "a", "b", "k"]
            plain = base.join(dim, ["a", "b"], "left").select(*fact.columns)
            rows.append(sorted(map(str, fact.collect())))
            rows.append(sorted(map(str, plain.collect())))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(r == rows[0] for r in rows) and len(rows[0]) == n


def test_date_dimension_keeps_null_and_dedups(spark):
    s = staged(spark)
    dim = D.date_dimension(s, ["arrdate", "depdate", "dtaddto"])
    dates = [r.datestamp for r in dim.collect()]
    assert None in dates and len(dates) == len(set(dates))
    assert dt.date(2016, 5, 1) in dates
    no_null = D.date_dimension(s, ["arrdate", "depdate"], keep_null=False)
    assert None not in [r.datestamp for r in no_null.collect()]


def test_date_dimension_one_scan_per_source(spark, tmp_path):
    p = str(tmp_path / "a")
    spark.createDataFrame(ARRIVALS, SCHEMA).write.parquet(p)
    df = spark.read.parquet(p).select(F.col("arrdate").cast("int").cast("string").alias("a"),
                                      F.col("depdate").cast("int").cast("string").alias("b"))
    plan = D.date_values(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_calendar_iso_week_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),)], "d date")
    r = D.date_dimension(df, ["d"]).collect()[0]
    assert (r.week, r.year, r.day_of_year, r.day_of_month, r.month) == (53, 2016, 1, 1, 1)


# airports — null code, padded code, one-part coordinate, duplicate code.
AIRPORTS = [
    ("JFK", "John F Kennedy", "New York", "US-NY", "US", "-73.77, 40.64"),
    (" LAX ", "Los Angeles", "Los Angeles", "US-CA", "US", "-118.4, 33.94"),
    (None, "Nowhere", "X", "US-XX", "US", "1.0, 2.0"),
    ("ONE", "One Part", "Y", "US-YY", "US", "5.5"),
    ("JFK", "JFK duplicate", "New York", "US-NY", "US", "-73.0, 40.0"),
]
AIR_COLS = ["iata_code", "name", "municipality", "iso_region", "iso_country", "coordinates"]


def test_entity_dimension(spark):
    df = spark.createDataFrame(AIRPORTS, AIR_COLS)
    dim = D.entity_dimension(df, "iata_code", AIR_COLS,
                             split=("coordinates", ",", ("latitude", "longitude")))
    rows = dim.collect()
    assert dim.columns == AIR_COLS[:-1] + ["latitude", "longitude"]
    assert len(rows) == 4                                             # no de-dup by default
    lax = [r for r in rows if r.iata_code == "LAX"][0]
    assert (lax.latitude, lax.longitude) == ("-118.4", "33.94")
    one = [r for r in rows if r.iata_code == "ONE"][0]
    assert one.longitude is None
    dd = D.entity_dimension(df, "iata_code", AIR_COLS, dedupe_key=True)
    assert dd.count() == 3


# demographics — duplicate whole row, same city under two races, null
# mean with non-null weight, zero total weight, null state.
DEMO = [
    ("NY", "New York", "White", 2.5, 100, 50),
    ("NY", "New York", "White", 2.5, 100, 50),        # whole-row duplicate
    ("NY", "New York", "Asian", 2.5, 100, 50),        # same city, other race
    ("NY", "Albany", "White", None, 100, 40),         # null mean, weight counts
    ("ZZ", "Zero", "White", 3.0, 0, 0),               # zero weight sum
    (None, "Nowhere", "White", 9.0, 10, 5),           # null state
]
DEMO_S = ("state_code string, city string, race string, average_household_size double, "
          "total_population int, male_population int")


def test_group_rollup_dimension(spark):
    df = spark.createDataFrame(DEMO, DEMO_S)
    dim = D.group_rollup_dimension(df, "state_code", ["male_population", "total_population"],
                                   "average_household_size", "total_population")
    got = {r.state_code: r for r in dim.collect()}
    assert set(got) == {"NY", "ZZ"}
    ny = got["NY"]
    assert ny.total_population == 300 and ny.male_population == 140
    assert abs(ny.average_household_size - (2.5 * 100 * 2) / 300) < 1e-12
    assert got["ZZ"].average_household_size is None


def test_weighted_average_ignore_weight_of_null(spark):
    df = spark.createDataFrame(DEMO, DEMO_S).dropDuplicates()
    out = A.weighted_average(df, "average_household_size", "total_population", "state_code",
                             ignore_weight_of_null=True)
    got = {r.state_code: r.weighted_avg for r in out.collect()}
    assert got["NY"] == 2.5 and None not in got


def test_group_sums_keep_names(spark):
    df = spark.createDataFrame(DEMO, DEMO_S)
    out = A.group_sums(df, "state_code", ["total_population"])
    assert out.columns == ["state_code", "total_population"]


def test_write_star_observes_counts(spark, tmp_path):
    from starbuild.plans.star import StarSpec, write_star
    s = staged(spark)
    spec = StarSpec(fact_name="facts", fact_key="cicid", flags=FLAGS, flag_dim_name="dim_status",
                    flag_key="status_flag_id", date_columns=["arrdate", "depdate"],
                    date_dim_name="dim_time",
                    fact_layout=[("cicid", "cicid", "int"), ("status", "status_flag_id", None),
                                 ("arrival_dt", "arrdate", None)])
    metrics = {}
    star = write_star(spark, s, spec, str(tmp_path / "star"), metrics=metrics)
    assert metrics["facts"] == {"rows": 8, "null_keys": 5}
    assert metrics["dim_status"]["rows"] == 2
    assert metrics["dim_time"]["rows"] == star.read(spark, "dim_time").count()
    fact = star.read(spark, "facts")
    assert fact.columns == ["cicid", "status", "arrival_dt"] and fact.count() == 8


@pytest.mark.parametrize("parts,reuse,aqe", [(3, True, True), (16, True, False), (16, False, True), (7, False, False)])
def test_sequence_ids_with_payload_columns(spark, parts, reuse, aqe):
    df = spark.range(0, 20000, 1, 9).select((F.col("id") * 7 % 20000).alias("k"),
                                            F.concat(F.lit("text"), F.col("id").cast("string")).alias("payload"))
    spark.conf.set("spark.sql.exchange.reuse", str(reuse).lower())
    spark.conf.set("spark.sql.adaptive.enabled", str(aqe).lower())
    try:
        got = with_sequence_id(df, ["k"], "sid", num_partitions=parts)
        assert got.where("k != sid").count() == 0 and got.select("sid").distinct().count() == 20000
        assert got.columns == ["k", "payload", "sid"]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_run_star_with_checks_and_sample(spark, tmp_path):
    from starbuild.plans.star import StarSpec, run_star
    s = staged(spark)
    spec = StarSpec(fact_name="facts", fact_key="cicid", flags=FLAGS, flag_dim_name="dim_status",
                    flag_key="status_flag_id", date_columns=["arrdate"], date_dim_name="dim_time",
                    fact_layout=[("cicid", "cicid", "int"), ("status", "status_flag_id", None)])
    run = run_star(spark, s, spec, str(tmp_path / "full"), write_checks=True)
    r = run.checks["reconcile_facts"].collect()[0]
    stored = spark.read.parquet(run.paths["_checks/reconcile_facts"]).collect()[0]
    assert stored.asDict() == r.asDict()
    assert (r.stage_rows, r.output_rows, r.keys_equal, r.duplicates) == (8, 8, True, 0)
    assert run.metrics["facts"]["rows"] == 8
    part = run_star(spark, s, spec, str(tmp_path / "part"), sample_fraction=0.5, seed=3,
                    checks=False)
    assert part.checks == {} and part.metrics["facts"]["rows"] <= 8


def test_group_rollup_dedupe_keys(spark):
    df = spark.createDataFrame(DEMO, DEMO_S)
    dim = D.group_rollup_dimension(df, "state_code", ["total_population"],
                                   dedupe_keys=["state_code", "city"])
    got = {r.state_code: r.total_population for r in dim.collect()}
    assert got == {"NY": 200, "ZZ": 0}          # New York once, Albany once


def test_fact_join_same_result_broadcast_or_salted(spark):
    s = staged(spark)
    dim = D.combination_dimension(s, FLAGS)
    a = FT.attach_dimension_key(s, dim, FLAGS, "status_flag_id")
    rows_a = sorted(a.collect(), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = FT.attach_dimension_key(s, dim, FLAGS, "status_flag_id", salt_by=["cicid"], salt_buckets=4)
        plan = b._jdf.queryExecution().executedPlan().toString()
        rows_b = sorted(b.collect(), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows_a == rows_b and a.columns == b.columns
    # The salt must be a shuffle key, not a residual join condition.
    assert re.search(r"SortMergeJoin \[[^\]]*_lsalt", plan), plan


def test_partitioned_fact_keeps_text_codes(spark, tmp_path):
    """Codes '01', '1', '1.0' are different texts, in folder names too."""
    from starbuild.plans.star import StarSpec, run_star
    s = spark.createDataFrame([(i, p, "x", dt.date(2020, 1, 1)) for i, p in enumerate(["01", "1", "1.0", "10", None])],
                              "id int, port string, f string, d date")
    ports = s.select("port").distinct()
    spec = StarSpec(fact_name="facts", fact_key="id", flags=["f"], flag_dim_name="dim_f", flag_key="f_id",
                    date_columns=["d"], date_dim_name="dim_d", entity_name="dim_ports", entity_key="port",
                    entity_columns=["port"], entity_fk="port",
                    fact_layout=[("id", "id", "int"), ("port", "port", None), ("f_id", "f_id", None)])
    rows = []
    for i, kw in enumerate([{}, {"fact_partition_by": ["port"]},
                            {"fact_partition_by": ["port"], "cluster": "range", "max_records_per_file": 1}]):
        run = run_star(spark, s, spec, str(tmp_path / str(i)), entity_src=ports, **kw)
        fact = run.star.read(spark, "facts")
        assert fact.columns == ["id", "port", "f_id"] and dict(fact.dtypes)["port"] == "string"
        rows.append((sorted(map(str, fact.collect())), run.checks["coverage_facts_dim_ports"].first()))
    assert rows[0] == rows[1] == rows[2] and rows[0][1].matched == 4


def test_checks_scan_the_staging_source_once(spark, tmp_path):
    """However many date columns there are."""
    from starbuild.operators.quality import key_counts, reconcile_counts
    s = spark.createDataFrame([(i, dt.date(2020, 1, 1 + i % 3), None if i % 2 else dt.date(2021, 1, 1)) for i in range(10)],
                              "id int, a date, b date")
    counts = key_counts(s, ["id", "a", "b"])
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2
    assert {(r["column"], r["rows"], r["uniq"]) for r in counts.collect()} == {("id", 10, 10), ("a", 10, 3), ("b", 10, 2)}
    one = reconcile_counts(s, "a", s.select("a").distinct(), "a", stage_counts=counts.checkpoint()).first()
    assert one == reconcile_counts(s, "a", s.select("a").distinct(), "a").first()
    assert {r["column"]: r["uniq"] for r in key_counts(s, ["id", "b"], approx=True).collect()} == {"id": 10, "b": 2}
    assert {r["column"]: r["rows"] for r in key_counts(s.where("false"), ["id"]).collect()} == {"id": 0}


def test_prefix_key_join_one_row_per_key(spark):
    from starbuild.operators.joins import hot_keys, prefix_key_join
    left = spark.createDataFrame([(1, "CA"), (2, None), (3, "NY"), (4, "CA")], "id int, st string")
    right = spark.createDataFrame([("US-CA", 1), ("CA", 2), ("US-TX", 3), (None, 4)], "code string, v int")
    for hot in ([], hot_keys(left, ["st"], least=1)):
        got = {r.id: r.v for r in prefix_key_join(left, "st", right, "code", "US-", how="left", hot=hot).collect()}
        assert got == {1: 2, 2: None, 3: None, 4: 2}
        assert prefix_key_join(left, "st", right, "code", "US-", hot=hot).count() == 2


def test_code_lists_and_nulls(spark):
    from starbuild.operators.quality import code_list_violations, code_lists_violations
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 9), ("b", 9)], "x string, y int")
    codes = spark.createDataFrame([("lx", "a"), ("ly", "1"), ("ly", None)], "list_name string, code string")
    got = {tuple(r) for r in code_lists_violations(df, {"x": "lx", "y": "ly"}, codes).collect()}
    assert got == {("x", "lx", "b", 2), ("y", "ly", "2", 1), ("y", "ly", "9", 2)}
    assert [tuple(r) for r in code_list_violations(df, "x", codes.where("list_name = 'lx'")).collect()] == [("b", 2)]


def test_fill_from_lookup_null_keys(spark):
    from starbuild.operators.joins import fill_from_lookup
    df = spark.createDataFrame([(1, "US", None), (2, None, None), (3, "CA", "NA*"), (4, "XX", None)],
                               "id int, country string, continent string")
    lk = spark.createDataFrame([("US", "NA"), ("CA", "NA"), ("US", "ZZ")], "c string, cont string")
    got = {r.id: r.continent for r in fill_from_lookup(df, "continent", "country", lk, "c", "cont")
           .collect()}
    assert got == {1: "NA", 2: None, 3: "NA*", 4: None}


def test_cluster_settings():
    from starbuild.session import cluster_settings
    s = cluster_settings(100 * 1024 ** 4, 8000)          # 100 TB on 8000 cores
    parts = int(s["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100_000 <= parts < 110_000
    assert int(cluster_settings(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"]) == 16
