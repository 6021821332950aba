import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quipu.operators import encode, joins


@pytest.fixture
def words(spark):
    rows = [(1, "pear", "x"), (2, "apple", "y"), (3, "Äpfel", "x"), (4, None, "x"), (5, "pear", "y"), (6, "", "x")]
    return spark.createDataFrame(rows, "id long, fruit string, mark string")


def test_codes_follow_sorted_order(words):
    dictionary = encode.fit_dictionary(words)
    found = {(r.column, r.value): r.code for r in dictionary.rows.collect()}
    assert [found["fruit", v] for v in ["", "apple", "pear", "Äpfel"]] == [0, 1, 2, 3]
    assert found["mark", "x"] == 0 and found["mark", "y"] == 1
    assert dictionary.sizes["fruit"][0] == 4


def test_codes_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % 701).alias("a"), (F.col("id") % 37).alias("b"))
        dictionary = encode.fit_dictionary(df, ["a", "b"])
        rows = dictionary.rows.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for column, values in (("a", [f"v{i}" for i in range(701)]), ("b", [str(i) for i in range(37)])):
        expected = {v: i for i, v in enumerate(sorted(values))}
        assert {r.value: r.code for r in rows if r.column == column} == expected


def test_encode_keeps_nulls_and_passes_other_columns(words):
    dictionary = encode.fit_dictionary(words, ["fruit"])
    rows = {r.id: r for r in encode.encode(words, dictionary).collect()}
    assert rows[4].fruit is None and rows[3].fruit == 3 and rows[1].mark == "x"


def test_unseen_policies(spark, words):
    dictionary = encode.fit_dictionary(words, ["fruit"])
    new = spark.createDataFrame([(1, "plum"), (2, "apple"), (3, None)], "id long, fruit string")
    with pytest.raises(PySparkException, match="unseen value in column fruit: plum"):
        encode.encode(new, dictionary).collect()
    rows = {r.id: r for r in encode.encode(new, dictionary, unseen="quarantine").collect()}
    assert rows[1].unseen == ["fruit"] and rows[2].unseen == [] and rows[3].unseen == []
    assert [r.id for r in encode.unseen_rows(new, dictionary).collect()] == [1]


def test_decode_undoes_encode(words):
    dictionary = encode.fit_dictionary(words)
    again = encode.decode(encode.encode(words, dictionary), dictionary)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, words.collect())) or {
        tuple(r) for r in again.collect()
    } == {tuple(r) for r in words.collect()}


def test_saved_dictionary_loads_the_same(spark, words, tmp_path):
    dictionary = encode.fit_dictionary(words)
    encode.save_dictionary(dictionary, str(tmp_path / "d"))
    loaded = encode.load_dictionary(spark, str(tmp_path / "d"))
    assert {tuple(r) for r in loaded.rows.collect()} == {tuple(r) for r in dictionary.rows.collect()}
    assert loaded.sizes == dictionary.sizes


@pytest.mark.parametrize("hot_share", [0.9, 0.1, 0.0001])
def test_large_join_equals_broadcast(spark, monkeypatch, hot_share):
    monkeypatch.setattr(joins, "HOT_SHARE", hot_share)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None))
    key = key.otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    df = spark.range(2000).select("id", key.alias("k"))
    lookup = spark.range(40).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    for table in (lookup, lookup.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))):
        expected = df.join(F.broadcast(table), ["k"], "left").select("id", "k", "v").collect()
        found = joins.hot_key_join(df, table, ["k"]).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, expected), key=repr)


def test_large_join_shuffles_no_hot_key(spark, monkeypatch):
    """Rows under the hot key are spread over the partitions of the shuffle."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.hot_key_join(df, lookup, ["k"])
        hot = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in hot) == 1000
    assert max(r["count"] for r in hot) < 300


def test_encode_through_the_large_join(words, monkeypatch):
    dictionary = encode.fit_dictionary(words)
    expected = {tuple(r) for r in encode.encode(words, dictionary).collect()}
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 0)
    assert not dictionary.small(["fruit"])
    assert {tuple(r) for r in encode.encode(words, dictionary).collect()} == expected


def test_one_hot_of_the_older_table(spark):
    """Level names and the dropped first level of an older table's columns."""
    # The levels of each column and the names that come of them.
    levels = {"cp": [1, 2, 3, 4], "restecg": [0, 1, 2], "slope": [1, 2, 3], "ca": [0, 1, 2, 3], "thal": [3, 6, 7]}
    rows = [tuple(v[i % len(v)] for v in levels.values()) for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in levels)).withColumn("age", F.lit(50))
    names = list(levels)
    out = encode.one_hot(df, encode.fit_dictionary(df, names), names)
    expected = (
        "age cp_2 cp_3 cp_4 restecg_1 restecg_2 slope_2 slope_3 ca_1 ca_2 ca_3 thal_6 thal_7"
    ).split()
    assert out.columns == expected
    assert dict(out.dtypes)["cp_2"] == "boolean"
    first = out.collect()[0]
    assert not any(first[c] for c in expected[1:])


def test_large_join_spreads_equal_rows(spark):
    """Rows that are alike in all columns do not meet in one task."""
    df = spark.range(1000).select(F.lit("hot").alias("k"))
    lookup = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = joins.hot_key_join(df, lookup, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in rows) == 1000 and max(r["count"] for r in rows) < 300


def test_broadcasts_are_checked_in_sum(spark, monkeypatch):
    df = spark.createDataFrame([(f"a{i}", f"b{i}", f"c{i}") for i in range(20)], "x string, y string, z string")
    dictionary = encode.fit_dictionary(df)
    expected = {tuple(r) for r in encode.encode(df, dictionary).collect()}
    assert dictionary.small(["x", "y", "z"]) == {"x", "y", "z"}
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 45)
    assert len(dictionary.small(["x", "y", "z"])) == 2
    assert {tuple(r) for r in encode.encode(df, dictionary).collect()} == expected


def test_one_hot_of_nulls_and_unseen_values(spark):
    fitted = encode.fit_dictionary(spark.createDataFrame([("a",), ("b",), ("c",)], "x string"))
    df = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in encode.one_hot(df, fitted, ["x"]).collect()] == [(False, False), (False, True), (False, False)]
    assert [r.active for r in encode.one_hot_sparse(df, fitted, ["x"]).collect()] == [[], [1], []]
    strange = spark.createDataFrame([("z",)], "x string")
    with pytest.raises(PySparkException, match="unseen"):
        encode.one_hot(strange, fitted, ["x"]).collect()
    assert [tuple(r) for r in encode.one_hot(strange, fitted, ["x"], unseen="null").collect()] == [(False, False)]


def test_many_levels_have_a_sparse_form(spark):
    df = spark.range(3000).select(F.col("id"), F.col("id").cast("string").alias("x"), (F.col("id") % 2).cast("string").alias("y"))
    found = encode.one_hot_sparse(df, encode.fit_dictionary(df, ["x", "y"]), ["x", "y"])
    places = [p for r in found.collect() for p in r.active]
    assert sorted(set(places)) == list(range(3000)) and len(places) == 2999 + 1500


def _wide(spark):
    """A frequent value, a frequent unknown one, nulls and rare ones; and a payload that none of this touches."""
    x = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 300))
    y = F.when(F.col("id") % 2 == 0, "strange").otherwise(F.concat(F.lit("y"), F.col("id") % 40))
    return spark.range(3000).select("id", x.alias("x"), y.alias("y"), F.lit("few").alias("z"), F.concat(F.lit("pad"), F.col("id")).alias("pad"))


@pytest.mark.parametrize("hot_share", [0.9, 0.1, 0.0001])
def test_large_columns_together(spark, monkeypatch, hot_share):
    df = _wide(spark)
    dictionary = encode.fit_dictionary(df.where("y <> 'strange'"), ["x", "y", "z"])
    monkeypatch.setattr(encode, "HOT_SHARE", hot_share)
    expected = encode.encode(df, dictionary, unseen="quarantine")
    for small in (set(), {"z"}, {"x"}):
        found = encode.encode(df, dictionary, unseen="quarantine", small=small)
        assert found.dtypes == expected.dtypes
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 0)
    assert {r.id for r in encode.unseen_rows(df, dictionary).collect()} == set(range(0, 3000, 2))


@pytest.mark.parametrize("columns", [["x"], ["x", "y", "z"]])
def test_large_columns_exchange_the_rows_once(spark, columns):
    """Whatever the number of columns; and rows whose values are all frequent are not exchanged at all."""
    df = _wide(spark)
    dictionary = encode.fit_dictionary(df, columns)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tree = encode.encode(df, dictionary, columns, small=set())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = tree.splitlines()

    def carries_rows(at):
        """Whether the payload column is among what stands below an exchange, up to the next scan."""
        return "pad#" in next(line for line in lines[at + 1 :] if "Project" in line or "Scan" in line)

    assert sum(carries_rows(i) for i, line in enumerate(lines) if "Exchange hashpartitioning" in line) == 1
    resolved = tree[: tree.index("Exchange")] if "Union" in tree else ""
    assert "Union" in tree and resolved.count("FileScan") == 1


def test_too_many_levels_for_columns(spark, monkeypatch):
    df = spark.range(50).select(F.col("id").cast("string").alias("x"))
    dictionary = encode.fit_dictionary(df)
    monkeypatch.setattr(encode, "ONE_HOT_LEVELS", 49)
    with pytest.raises(ValueError, match="one_hot_sparse"):
        encode.one_hot(df, dictionary, ["x"])
