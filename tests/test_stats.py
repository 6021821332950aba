import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quipu.operators import encode, metrics, stats


def test_correlation_skips_nulls_and_constant_columns(spark):
    rows = [(1.0, 5.0, 2.0, 0), (2.0, 5.0, None, 1), (4.0, 5.0, 7.0, 1), (8.0, 5.0, 1.0, 0), (9.0, 5.0, 3.0, 1)]
    df = spark.createDataFrame(rows, "a double, k double, n double, y int")
    report = stats.correlation_with_target(df, ["a", "k", "n"], "y").collect()
    found = {r.feature: r.correlation for r in report}
    assert found["k"] is None and report[-1].feature == "k"
    assert found["a"] == pytest.approx(df.agg(F.corr("a", "y")).first()[0])
    assert found["n"] == pytest.approx(df.filter("n is not null").agg(F.corr("n", "y")).first()[0])
    values = [r.correlation for r in report if r.correlation is not None]
    assert values == sorted(values)


def test_correlation_of_one_row_is_null(spark):
    df = spark.createDataFrame([(1.0, 1)], "a double, y int")
    assert stats.correlation_with_target(df, ["a"], "y").first().correlation is None


def _gain(pairs):
    n = len(pairs)
    xy, x, y = Counter(pairs), Counter(p[0] for p in pairs), Counter(p[1] for p in pairs)
    return sum(c / n * math.log(c * n / (x[a] * y[b])) for (a, b), c in xy.items())


def test_information_gain(spark):
    rows = [(i % 5, "same", i % 7 % 2, i % 3) for i in range(210)]
    df = spark.createDataFrame(rows, "a int, k string, copy int, y int").withColumn("copy", F.col("y"))
    found = {r.feature: r.information_gain for r in stats.information_gain(df, ["a", "k", "copy"], "y").collect()}
    assert found["k"] == pytest.approx(0, abs=1e-12)
    assert found["copy"] == pytest.approx(math.log(3))
    assert found["a"] == pytest.approx(_gain([(r[0], r[3]) for r in rows]), abs=1e-12)


def test_information_gain_of_bins(spark):
    rows = [(float(i * i % 97), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "v double, y int")
    edges = stats.bin_edges(df, ["v"], 4)["v"]
    ordered = sorted(r[0] for r in rows)
    assert edges == [ordered[99], ordered[199], ordered[299]]
    expected = _gain([(sum(e < v for e in edges), y) for v, y in rows])
    report = stats.information_gain(df, ["v"], "y", numeric=["v"], bins=4).first()
    assert report.information_gain == pytest.approx(expected, abs=1e-12)


def test_category_map(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "1"), ("b", None), ("ñ", "2")], "x string, y string")
    found = {r["column"]: r["values"] for r in stats.category_map(encode.fit_dictionary(df), ["x", "y"]).collect()}
    assert found == {"x": ["a", "b", "ñ"], "y": ["1", "2"]}


def test_pages_of_values(spark):
    df = spark.range(1000).select(F.concat(F.lit("v"), F.col("id")).alias("x"), (F.col("id") % 3).cast("string").alias("y"))
    dictionary = encode.fit_dictionary(df)
    assert stats.inline_columns(dictionary, ["x", "y"], 100) == ["y"]
    assert stats.inline_columns(dictionary, ["x", "y"]) == ["y", "x"]
    pages = stats.category_pages(dictionary, ["x"], 64).orderBy("page").collect()
    assert [len(r["values"]) for r in pages] == [64] * 15 + [40]
    assert [v for r in pages for v in r["values"]] == sorted(f"v{i}" for i in range(1000))


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(0.0, 3.0), (1.0, 3.0), (1.0, 3.0), (0.0, 3.0)], "p double, k double")
    found = {r["column"]: r for r in stats.scaler_stats(df, ["p", "k"]).collect()}
    assert found["p"]["std"] == pytest.approx(0.5) and found["p"]["mean"] == 0.5
    assert {tuple(r) for r in stats.standardize(df, ["p", "k"]).collect()} == {(-1.0, 0.0), (1.0, 0.0)}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, 1), (1, 0), (0, 1), (0, 0)], 0.5),
        ([(0, 0), (0, 0)], 0.0),
        ([(1, 1)], 1.0),
        ([(1, 0), (0, 1)], 0.0),
    ],
)
def test_f1_of_the_positive_class(spark, rows, expected):
    df = spark.createDataFrame(rows, "y int, p int").withColumn("p", F.col("p").cast("double"))
    assert metrics.score(df, "f1", "y", "p").first().f1 == expected


def test_accuracy_per_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("b", 0, 0)], "g string, y int, p int")
    assert {r.g: r.accuracy for r in metrics.score(df, "accuracy", "y", "p", ["g"]).collect()} == {"a": 0.5, "b": 1.0}


def test_fractional_columns_are_binned_without_being_told(spark):
    """Noise in a continuous column says nearly nothing about the class."""
    df = spark.range(4000).select(F.rand(5).alias("noise"), (F.rand(6) < 0.5).cast("int").alias("y"))
    assert stats.information_gain(df, ["noise"], "y", bins=8).first().information_gain < 0.01
    told = stats.information_gain(df, ["noise"], "y", numeric=[]).first().information_gain
    assert told == pytest.approx(math.log(2), abs=0.01)


def test_thin_integers_are_binned(spark):
    """A key says as much about any target as the target itself if each value counts for itself."""
    df = spark.range(2000).selectExpr("id", "id % 7 AS code", "cast(hash(id) % 2 = 0 AS int) AS y")
    found = {r.feature: r.information_gain for r in stats.information_gain(df, ["id", "code"], "y").collect()}
    assert found["id"] < 0.03 and found["code"] < 0.01
    counted = {r.feature: r.information_gain for r in stats.information_gain(df, ["id"], "y", numeric=[]).collect()}
    assert counted["id"] > 0.6
