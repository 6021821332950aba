"""The shape of physical plans: what must not shuffle, what must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

from quipu.operators import clean, encode, split, stats
from quipu.plans import fixtures
from quipu.schema import MARRIAGES
from quipu.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange SinglePartition")


@pytest.fixture
def orders(spark):
    return table(spark, FOLDER, "orders")


def test_assigning_parts_does_not_shuffle_the_table(orders):
    parts = split.train_test_split(orders, ["o_orderkey"], 1, 0.3, "o_orderstatus")
    assert shuffles(parts) == 0
    raw, cleaned = split.paired_sample(orders, orders, ["o_orderkey"], 10, 1)
    assert "Exchange" not in plan(raw) + plan(cleaned)


def test_encoding_by_small_dictionaries_does_not_shuffle_the_table(orders):
    dictionary = encode.fit_dictionary(orders, ["o_orderstatus", "o_orderpriority"])
    encoded = encode.encode(orders, dictionary)
    assert shuffles(encoded) == 0 and plan(encoded).count("BroadcastHashJoin") == 2


def test_unused_columns_are_not_read(orders):
    report = stats.correlation_with_target(orders.withColumn("y", F.col("o_custkey") % 2), ["o_totalprice"], "y")
    text = plan(report)
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_one_split_is_read_from_its_own_files(spark, orders, tmp_path):
    parts = split.train_test_split(orders, ["o_orderkey"], 1, 0.3)
    parts.write.partitionBy("split").parquet(str(tmp_path / "s"))
    one = spark.read.parquet(str(tmp_path / "s")).filter("split = 'test'")
    assert "PartitionFilters: [isnotnull(split" in plan(one)


def test_ordered_work_shuffles_the_table_once(spark, orders):
    from quipu.operators import ordered

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = ordered.numbered(orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", ["o_orderstatus"], rows_per_range=200)
        tree = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    join = tree[tree.index("Join") :]
    data_side = join[: join.index("Project", join.index("Window"))]
    assert data_side.count("Exchange hashpartitioning(_group") == 1


def test_later_rounds_of_a_split_read_only_near_rows(monkeypatch, orders):
    seen = []
    near = split._near
    monkeypatch.setattr(split, "_near", lambda rows, *a: seen.append(rows) or near(rows, *a))
    split.train_test_split(orders, ["o_orderkey"], 1, 0.3, rank_rows=1)
    sources = [str(rows._jdf.queryExecution().optimizedPlan()) for rows in seen]
    assert len(sources) > 1 and "orders" in sources[0] or "md5" in sources[0]
    assert not any("md5" in source for source in sources[1:])


def test_values_collapse_before_the_shuffle(orders):
    text = plan(encode.distinct_values(orders, ["o_orderstatus"]))
    assert text.count("HashAggregate") == 2


def test_code_of_cleaning_and_encoding_is_small_enough_to_be_compiled(spark):
    cleaned = clean.clean(fixtures.raw_marriages(spark, FOLDER), MARRIAGES)
    dictionary = encode.fit_dictionary(cleaned, MARRIAGES.text_features)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for unseen in ("error", "quarantine"):
            encoded = encode.encode(cleaned, dictionary, MARRIAGES.text_features, unseen)
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
            sizes = re.findall(r"maxMethodCodeSize:(\d+)", encoded._jdf.queryExecution().explainString(mode))
            assert sizes and max(map(int, sizes)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_parts_of_a_table_stay_as_they_are_between_steps(spark):
    rows = spark.range(0, 1000, 1, 7).withColumn("part", F.spark_partition_id())
    kept = encode.apart(rows).withColumn("now", F.spark_partition_id())
    assert kept.rdd.getNumPartitions() == 7 and kept.where("part <> now").isEmpty()
