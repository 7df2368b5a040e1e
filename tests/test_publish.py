"""Runs that fail, runs at the same time, and loads in parts."""
import datetime as dt
import os

import pytest

from starbuild.operators import dims as D
from starbuild.plans import publish as pub
from starbuild.plans import star as stars
from starbuild.plans.star import StarSpec
from starbuild.sources import sinks

SPEC = StarSpec(fact_name="facts", fact_key="id", flags=["f", "g"], flag_dim_name="dim_f", flag_key="f_id",
                date_columns=["d"], date_dim_name="dim_d", entity_name="dim_ports", entity_key="port",
                entity_columns=["port"], entity_fk="port",
                fact_layout=[("id", "id", "bigint"), ("f_id", "f_id", None), ("port", "port", None), ("d", "d", None)])
SCHEMA = "id int, f string, g int, port string, d date"


def rows(ids, flags):
    return [(i, flags[i % len(flags)], i % 2, ["", "A", None][i % 3], dt.date(2020, 1, 1 + i % 5)) for i in ids]


def load(spark, root, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return pub.load_star(spark, df, SPEC, root, entity_src=df.select("port").distinct(), fact_partition_by=["port"], **kw)


def star_of(spark, root, manifest=None):
    return {n: sorted(map(str, pub.read_table(spark, root, n, manifest).collect()))
            for n in ("facts", "dim_f", "dim_d", "dim_ports")}


def flags_of(spark, root, manifest=None):
    """(id, flags) of every fact, through the dimension."""
    fact, dim = (pub.read_table(spark, root, n, manifest) for n in ("facts", "dim_f"))
    return sorted((r.id, r.f, r.g) for r in fact.join(dim, "f_id").collect())


def test_first_load_and_rerun_agree(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert pub.latest(spark, root) is None
    with pytest.raises(KeyError):
        pub.read_table(spark, root, "facts")
    a = load(spark, root, rows(range(20), "xy"))
    first = star_of(spark, root)
    b = load(spark, root, rows(range(20), "xy"))
    assert (a.number, b.number) == (1, 2) and a.run != b.run and star_of(spark, root) == first == star_of(spark, root, a)
    assert a.tables["facts"].content == b.tables["facts"].content and b.tables["facts"].rows == 20
    assert a.high_water == b.high_water == {"dim_f": 2}


@pytest.mark.parametrize("table", ["facts", "dim_d", "dim_f", "dim_ports"])
def test_failed_run_leaves_the_former_star(spark, tmp_path, monkeypatch, table):
    root = str(tmp_path)
    load(spark, root, rows(range(20), "xy"))
    before, plain = star_of(spark, root), sinks.write_parquet

    def failing(df, path, **kw):
        if path.endswith("/" + table):
            raise OSError("disk full")
        return plain(df, path, **kw)

    monkeypatch.setattr(sinks, "write_parquet", failing)
    with pytest.raises(OSError, match="disk full"):
        load(spark, root, rows(range(40), "xyz"))
    monkeypatch.undo()
    assert star_of(spark, root) == before and pub.latest(spark, root).number == 1
    assert load(spark, root, rows(range(40), "xyz")).number == 2        # the claim was given back
    assert star_of(spark, root) != before


def test_changed_content_is_not_published(spark, tmp_path, monkeypatch):
    from starbuild.operators import facts
    plain = facts.build_fact
    monkeypatch.setattr(facts, "build_fact", lambda *a: plain(*a).where("id <> 3"))
    with pytest.raises(ValueError, match="staged rows"):
        load(spark, str(tmp_path), rows(range(9), "x"))
    assert pub.latest(spark, str(tmp_path)) is None


def test_two_runs_from_one_manifest(spark, tmp_path):
    """The second one publishes nothing, so no key has two meanings."""
    root = str(tmp_path)
    load(spark, root, rows(range(20), "xy"))
    inner = []

    def build(run, base):
        with pytest.raises(pub.PublishConflict):
            load(spark, root, rows(range(30), "xyz"), append=True)
        inner.append(base.number)
        return base

    assert pub.publish(spark, root, build).number == 2 and inner == [1]
    assert load(spark, root, rows(range(20, 30), "xyz"), append=True).number == 3


def test_claim_of_a_killed_run(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, rows(range(5), "x"))
    open(os.path.join(root, "manifests", "0000000002.claim"), "w").close()
    with pytest.raises(pub.PublishConflict):
        load(spark, root, rows(range(6), "x"))
    pub.release(spark, root, 2)
    assert load(spark, root, rows(range(6), "x")).number == 2


def test_loads_in_parts_keep_keys(spark, tmp_path):
    root = str(tmp_path)
    a = load(spark, root, rows(range(0, 10), "mz"), append=True)
    old = {(r.f, r.g): r.f_id for r in pub.read_table(spark, root, "dim_f").collect()}
    b = load(spark, root, rows(range(10, 40), "abmz"), append=True)
    new = {(r.f, r.g): r.f_id for r in pub.read_table(spark, root, "dim_f").collect()}
    assert old.items() <= new.items() and sorted(new.values()) == list(range(len(new))) and len(new) > len(old)
    assert a.high_water["dim_f"] == len(old) and b.high_water["dim_f"] == len(new)
    want = sorted((i, f, g) for i, f, g, *_ in rows(range(10), "mz") + rows(range(10, 40), "abmz"))
    assert flags_of(spark, root) == want and flags_of(spark, root, a) == [w for w in want if w[0] < 10]
    facts = pub.read_table(spark, root, "facts")
    assert sorted((r.id, r.port) for r in facts.collect()) == [(i, ["", "A", None][i % 3]) for i in range(40)]
    assert pub.read_table(spark, root, "dim_d").count() == 5
    # a whole load replaces the facts and still keeps the keys
    load(spark, root, rows(range(3), "a"))
    assert flags_of(spark, root) == [(0, "a", 0), (1, "a", 1), (2, "a", 0)]
    assert {(r.f, r.g): r.f_id for r in pub.read_table(spark, root, "dim_f").collect()} == new | {("a", 1): len(new)}


def test_expire_removes_only_superseded_runs(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, rows(range(4), "x"))
    load(spark, root, rows(range(4, 8), "x"), append=True)
    load(spark, root, rows(range(9), "x"))
    last = load(spark, root, rows(range(9, 12), "x"), append=True)
    os.makedirs(os.path.join(root, "runs", "under-way"))
    gone = pub.expire(spark, root, keep=1)
    assert len(gone) == 2 and sorted(os.listdir(os.path.join(root, "runs")))[-1] == "under-way"
    assert pub.latest(spark, root).number == last.number and pub.read_table(spark, root, "facts").count() == 12


def test_extend_combinations(spark):
    known = spark.createDataFrame([("b", 7), ("z", 3)], "f string, k long")
    combos = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "f string, rows long")
    got = {r.f: r.k for r in D.extend_combinations(known, combos, ["f"], "k", 8).collect()}
    assert got == {"b": 7, "z": 3, "a": 8, "c": 9}
    assert {r.f: r.k for r in D.extend_combinations(None, combos, ["f"], "k").collect()} == {"a": 0, "b": 1, "c": 2}
    assert stars.dims is D
