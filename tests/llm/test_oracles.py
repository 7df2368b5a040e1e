"""Every query of the subpackage that has SQL against it (values and types)."""
import duckdb
import pytest

from starbuild.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "pages"):
        con.sql(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    df, want = QUERIES[name](spark, sf_dir), con.sql(ORACLE[name])
    assert df.columns == want.columns
    assert [TYPES[t] for _, t in df.dtypes] == list(map(str, want.types))
    order = lambda r: (r[0], str(r))
    for g, w in zip(sorted(map(tuple, df.collect()), key=order), sorted(want.fetchall(), key=order), strict=True):
        assert g == pytest.approx(w) if any(isinstance(x, float) for x in g) else g == w


def test_registered_names():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
    assert set(ORACLE) < set(QUERIES)


def test_cutoffs_equal_the_sql_where_there_are_some(spark):
    """sf0.1 has labels enough for certified cutoffs of one stratum: they reject
    documents that pass the base rules, the same ones in SQL."""
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    got = sorted(map(tuple, QUERIES["op1_quality_thresholds"](spark, sf).collect()))
    want = con.sql(ORACLE["op1_quality_thresholds"])
    assert got == sorted(want.fetchall())
    failed, kept = (want.columns.index(c) for c in ("base_failed", "kept"))
    assert sum(not r[failed] and not r[kept] for r in got) > 50


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_license_scan"])
def test_new_queries_equal_their_sql_on_more_rows(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf}/documents.parquet'")
    got = sorted(map(tuple, QUERIES[name](spark, sf).collect()), key=str)
    assert got == sorted(con.sql(ORACLE[name]).fetchall(), key=str)
