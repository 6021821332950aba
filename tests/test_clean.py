import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from quipu.operators import clean
from quipu.schema import MARRIAGES


def test_projection_keeps_the_declared_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.project(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(PySparkException):
        clean.project(df, ["missing"])


def test_feature_order_is_not_the_type_order():
    features = MARRIAGES.features
    assert features.index("sabe_leer2") + 1 == features.index("sabe_leer1")
    assert len(features) == 19 and len(MARRIAGES.text_features) == 14


def test_bad_cast_stops_or_becomes_null(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(PySparkException):
        clean.cast_types(df, {"a": T.LongType()}).collect()
    assert [r.a for r in clean.cast_types(df, {"a": T.LongType()}, "null").collect()] == [1, None]


def test_floats_are_cut_to_integers(spark):
    df = spark.createDataFrame([(3.7,), (-3.7,)], "a double")
    assert [r.a for r in clean.cast_types(df, {"a": T.LongType()}).collect()] == [3, -3]


def test_null_policies(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "t string, n long")
    with pytest.raises(PySparkException, match="null in column t"):
        clean.apply_null_policy(df, ["t", "n"]).collect()
    assert [r.t for r in clean.apply_null_policy(df, ["t", "n"], "literal").collect()] == ["a", "nan"]
    assert clean.apply_null_policy(df, ["t"], "keep").collect()[1].t is None
    numbers = spark.createDataFrame([(None,)], "n long")
    with pytest.raises(PySparkException, match="null in column n"):
        clean.apply_null_policy(numbers, ["n"], "literal").collect()
    with pytest.raises(ValueError):
        clean.apply_null_policy(df, ["t"], "other")


def test_bool_to_int(spark):
    df = spark.createDataFrame([(True, 5), (False, 6), (None, 7)], "f boolean, n int")
    out = clean.bool_to_int(df)
    assert out.schema["f"].dataType == T.IntegerType()
    assert [r.f for r in out.collect()] == [1, 0, None]
    assert clean.bool_to_int(df, ["n"]).schema["f"].dataType == T.BooleanType()


def test_whole_numbers_may_come_with_a_fraction(spark):
    df = spark.createDataFrame([("3.0",), ("12",), ("-4.9",), ("9007199254740993",), (None,)], "a string")
    found = [r.a for r in clean.cast_types(df, {"a": T.LongType()}).collect()]
    assert found == [3, 12, -4, 9007199254740993, None]


def test_a_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="missing"):
        clean.cast_types(spark.createDataFrame([(1,)], "a int"), {"missing": T.LongType()})


def test_large_whole_numbers_as_text_are_exact(spark):
    texts = ["9007199254740993.0", "-9223372036854775808", "9223372036854775807.9", "1e3", " 7 ", "12.999999"]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    wanted = [9007199254740993, -9223372036854775808, 9223372036854775807, 1000, 7, 12]
    for policy in ("error", "null"):
        assert [r.a for r in clean.cast_types(df, {"a": T.LongType()}, policy).collect()] == wanted


def test_integers_with_a_fraction_are_not_tried_as_integers(spark):
    texts = ["3.0", "-7", "+4", " 5 ", "1e3", "9007199254740993", "9007199254740993.0", "-0.9", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    cast = clean.cast_types(df, {"a": T.LongType()})
    assert [r.a for r in cast.orderBy("i").collect()] == [3, -7, 4, 5, 1000, 9007199254740993, 9007199254740993, 0, None]
    # A failing cast throws, for each row: only texts without a point reach the one to an integer.
    assert "NOT contains(a" in cast._jdf.queryExecution().optimizedPlan().toString().replace("Contains", "contains")
