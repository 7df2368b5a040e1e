"""Content fingerprints: what they see and what they ignore."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from starbuild.operators import fingerprint as fp
from starbuild.plans.star import StarSpec, run_star, write_star

ROWS = [(1, "a", 1.5, None), (2, "b", 2.5, {"x": 1, "y": 2}), (2, "b", 2.5, {"x": 1, "y": 2}), (3, None, None, {})]
SCHEMA = "id int, t string, v double, m map<string,int>"


def test_order_and_partitions_do_not_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = fp.content_fingerprint(df)
    assert a == fp.content_fingerprint(df.repartition(3).orderBy(F.desc("id")))
    assert a == fp.content_fingerprint(spark.createDataFrame([*ROWS[2:], *ROWS[:2]], SCHEMA))
    assert a.rows == 4 and len(a.text) == 32
    assert fp.content_fingerprint(df.where("false")) == fp.Fingerprint(0, (0,) * 8)


@pytest.mark.parametrize("change", [
    lambda r: [r[0][:2] + (2.5, None), r[1][:2] + (1.5, r[1][3]), *r[2:]],       # values swapped between rows
    lambda r: r[:3], lambda r: [*r, r[0]], lambda r: [r[0], r[1], r[0], r[3]],      # row lost, repeated, exchanged
    lambda r: [(None, "a", 1.5, None), *r[1:]], lambda r: [(1, "a", None, None), *r[1:]],
    lambda r: [*r[:3], (3, "", None, {})], lambda r: [*r[:3], (3, None, None, None)]])
def test_changes_are_seen(spark, change):
    a, b = (fp.content_fingerprint(spark.createDataFrame(r, SCHEMA)) for r in (ROWS, change(ROWS)))
    assert a != b and a.text != b.text


def test_null_in_another_column_is_another_row(spark):
    a, b = (fp.content_fingerprint(spark.createDataFrame([r], "a int, b int")) for r in ((None, 1), (1, None)))
    assert a != b


def _star(spark):
    rows = [(i, "x" if i % 3 else None, f"p{i % 4}" if i % 5 else "", dt.date(2020, 1, 1 + i % 9), i * 1.5) for i in range(50)]
    staged = spark.createDataFrame(rows, "id int, f string, port string, d date, amount double")
    spec = StarSpec(fact_name="facts", fact_key="id", flags=["f"], flag_dim_name="dim_f", flag_key="f_id",
                    date_columns=["d"], date_dim_name="dim_d",
                    fact_layout=[("id", "id", "bigint"), ("f_id", "f_id", None), ("port", "port", None), ("amount", "amount", "int")])
    return staged, spec


@pytest.mark.parametrize("layout", [{}, {"fact_partition_by": ["port"]}, {"fact_partition_by": ["port"], "cluster": "range"}])
def test_star_reports_equal_content_and_true_counts(spark, tmp_path, layout):
    staged, spec = _star(spark)
    run = run_star(spark, staged, spec, str(tmp_path), **layout)
    assert run.checks["content_facts"].first() == (50, 50, True, True)
    assert run.metrics["facts"] == {"rows": 50, "null_keys": 17} and run.metrics["dim_d"]["rows"] == 9
    for name, content in run.star.content.items():
        back = run.star.read(spark, name)
        assert content == fp.content_fingerprint(back.drop("f_id") if name == "facts" else back)


def test_star_sees_a_value_that_changed_on_the_way(spark, tmp_path, monkeypatch):
    from starbuild.operators import facts
    staged, spec = _star(spark)
    plain = facts.build_fact

    def swapping(*args):
        return plain(*args).withColumn("amount", F.when(F.col("id") == 3, 6).when(F.col("id") == 4, 4).otherwise(F.col("amount")))

    monkeypatch.setattr(facts, "build_fact", swapping)
    run = run_star(spark, staged, spec, str(tmp_path))
    assert run.checks["content_facts"].first() == (50, 50, True, False)
    assert run.checks["reconcile_facts"].first().keys_equal


def test_no_extra_job_in_the_fact_write(spark, tmp_path):
    """Staging rows are read once for the fact and its fingerprint together."""
    staged, spec = _star(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = staged.mapInArrow(count, staged.schema)
    star = write_star(spark, counted, spec, str(tmp_path))
    # the combinations, the dates and the fact: one scan each
    assert seen.value == 3 * 50 and star.staged_content == star.content["facts"]
