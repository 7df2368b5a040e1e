import datetime as dt

import pytest
from pyspark.sql.types import StructType

from starbuild.operators import columns as C
from starbuild.sources import schema as S


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" City Name", "Median-Age", "STATE_code "])
    assert C.normalize_headers(df).columns == ["city_name", "median_age", "state_code"]


def test_normalize_headers_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    with pytest.raises(ValueError):
        C.normalize_headers(df)


def test_cast_truncates_and_nulls_junk(spark):
    df = spark.createDataFrame([("12.7",), ("-3.9",), ("abc",), (None,), ("123456789012345678",)],
                               "v string")
    out = C.cast_columns(df, ["v"], "int").collect()
    assert [r.v for r in out] == [12, -3, None, None, None]          # last overflows int
    big = C.cast_columns(df, ["v"], "bigint").collect()
    assert big[-1].v == 123456789012345678                           # exact, not via double


def test_cast_double_to_int_truncates(spark):
    df = spark.createDataFrame([(20573.9,), (-0.5,)], "v double")
    assert [r.v for r in C.cast_columns(df, ["v"], "int").collect()] == [20573, 0]


def test_epoch_days(spark):
    df = spark.createDataFrame([(20573.0,), (20573.9,), (0.0,), (None,)], "d double")
    out = [r.d for r in C.decode_epoch_days(df, ["d"]).collect()]
    day = dt.date(1960, 1, 1) + dt.timedelta(days=20573)
    assert out == [day, day, dt.date(1960, 1, 1), None]


def test_pattern_dates_malformed_is_null(spark):
    df = spark.createDataFrame([("04302016", "20160430"), ("D/S", "2016043"), (None, None)],
                               "dtaddto string, dtadfile string")
    out = C.parse_pattern_dates(df, {"dtaddto": "MMddyyyy", "dtadfile": "yyyyMMdd"}).collect()
    assert out[0].dtaddto == dt.date(2016, 4, 30) and out[0].dtadfile == dt.date(2016, 4, 30)
    assert out[1].dtaddto is None and out[1].dtadfile is None
    assert out[2].dtaddto is None


def test_require_non_null_sets_schema(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, v string")
    out = C.require_non_null(df, ["k"])
    assert not out.schema["k"].nullable and out.schema["v"].nullable
    assert sorted(r.k for r in out.collect()) == [1, 3]


def test_split_pair_one_part(spark):
    df = spark.createDataFrame([("-73.9, 40.7",), ("12.5",), (None,)], "coordinates string")
    out = C.split_pair(df, "coordinates", ",", ("latitude", "longitude")).collect()
    assert (out[0].latitude, out[0].longitude) == ("-73.9", "40.7")
    assert (out[1].latitude, out[1].longitude) == ("12.5", None)
    assert (out[2].latitude, out[2].longitude) == (None, None)


def test_project_layout(spark):
    df = spark.createDataFrame([(1.0, "x", 7)], "a double, b string, c int")
    out = C.project(df, [("b2", "b", None), ("a2", "a", "int")])
    assert out.columns == ["b2", "a2"] and out.collect()[0].a2 == 1


def test_schema_roundtrip_and_conform(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    sch = S.schema_from_json(S.schema_to_json(df.select("v", "k")))
    assert S.read_schema(spark, S.write_schema(df.select("v", "k"), str(tmp_path / "schema"))) == sch
    assert isinstance(sch, StructType)
    assert S.conform(df, sch).columns == ["v", "k"]
    with pytest.raises(ValueError):
        S.conform(df.drop("v"), sch)
    assert S.conform(df.drop("v"), sch, allow_missing=True).collect()[0].v is None


def test_nullability_violations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    strict = StructType.fromJson({"type": "struct", "fields": [
        {"name": "k", "type": "integer", "nullable": False, "metadata": {}},
        {"name": "v", "type": "string", "nullable": True, "metadata": {}}]})
    rows = S.nullability_violations(df, strict).collect()
    assert [(r.column, r.nulls) for r in rows] == [("k", 1)]


def test_one_projection_per_operator(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    out = C.cast_columns(df, ["a", "b", "c"], "int")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1
