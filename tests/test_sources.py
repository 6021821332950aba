import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu import session
from quipu.functions import paths, text
from quipu.plans import etl, fixtures
from quipu.schema import DESCRIBED_CATEGORIES, MARRIAGES
from quipu.sources.delimited import read_csv, read_named, write_csv
from quipu.sources.dictionary import entries, read_entries, write_entries
from quipu.sources.store import Store
from quipu.sources.documents import read_json_or_empty, signature_schema


def test_csv_keeps_null_empty_and_special_text(spark, tmp_path):
    schema = "id long, t string, x double"
    rows = [(1, None, 0.1), (2, "", None), (3, "NA", 1e300), (4, 'a "b", c', -0.0), (5, "Indígena", 2.5), (6, "null", 1.0)]
    df = spark.createDataFrame(rows, schema)
    write_csv(df, str(tmp_path / "c"))
    again = read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, again.collect())) == rows


def test_csv_with_a_bad_number_stops(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,t\n1,a\nx,b\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_csv(spark, str(tmp_path / "f.csv"), T.StructType.fromDDL("id long, t string")).collect()


def test_absent_document_is_empty(spark, tmp_path):
    schema = T.StructType.fromDDL("a long")
    assert read_json_or_empty(spark, str(tmp_path / "no"), schema).count() == 0
    assert read_entries(spark, str(tmp_path / "no")).count() == 0
    (tmp_path / "bad.json").write_text('{"a": "x"}')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_json_or_empty(spark, str(tmp_path / "bad.json"), schema).collect()


def test_entries_round_trip(spark, tmp_path):
    row = spark.range(1).select(F.array(F.lit("á"), F.lit('q"')).alias("a"), F.lit("x/y").alias("t"), F.lit(2.5).alias("n"))
    df = entries(row, names=F.col("a"), target=F.col("t"), share=F.col("n"))
    write_entries(df, str(tmp_path / "d"))
    found = {r.key: r.value for r in read_entries(spark, str(tmp_path / "d")).collect()}
    assert found == {"names": '["á","q\\""]', "target": '"x/y"', "share": "2.5"}


def test_signature_text_gives_the_schema():
    schema = MARRIAGES.feature_schema()
    assert signature_schema(schema.json()) == schema


def test_paths(spark):
    df = spark.createDataFrame([("s3://data/raw/a.csv",), ("s3://only",), (None,)], "p string")
    rows = df.select(paths.bucket(F.col("p"), "s3://").alias("b"), paths.key(F.col("p"), "s3://").alias("k")).collect()
    assert [tuple(r) for r in rows] == [("data", "raw/a.csv"), ("only", None), (None, None)]
    wrong = spark.createDataFrame([("file:/x",)], "p string")
    with pytest.raises(PySparkException, match="does not start with s3://"):
        wrong.select(paths.bucket(F.col("p"), "s3://")).collect()


def test_tags_replace_and_add(spark):
    base = text.tags(a=F.lit(1), b=F.lit("x"))
    row = spark.range(1).select(text.with_tags(base, b=F.lit("y"), c=F.lit(0.5)).alias("m")).first()
    assert row.m == {"a": "1", "b": "y", "c": "0.5"}


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    assert session.new_path(spark, "x").startswith(configured)


def test_local_frame(spark):
    schema = "a long, m map<string,double>, l array<string>, t string"
    rows = [(1, {"x": 0.5}, ["p"], None), (2, {}, [], "é")]
    df = session.local_frame(spark, rows, schema)
    assert [(r.a, r.m, r.l, r.t) for r in df.collect()] == rows
    assert session.local_frame(spark, [], schema).count() == 0


def test_etl_merges_the_description_of_an_earlier_run(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    write_csv(fixtures.raw_marriages(spark, folder), str(tmp_path / "in"))
    layout = etl.Layout(str(tmp_path / "out"))
    old = spark.createDataFrame([("note", '"kept"'), ("target_col", '"num"')], "key string, value string")
    write_entries(old, layout.description)
    for _ in range(2):
        etl.run(spark, str(tmp_path / "in"), layout, MARRIAGES, DESCRIBED_CATEGORIES, 42)
    found = {r.key: r.value for r in read_entries(spark, layout.description).collect()}
    assert found["note"] == '"kept"' and found["target_col"] == '"es_divorcio"' and len(found) == 9
    train, test = (etl.read_split(spark, layout, part) for part in ("train", "test"))
    assert (train.count(), test.count()) == (1050, 450)
    assert train.columns == ["row_id", *MARRIAGES.features, MARRIAGES.target]
    assert etl.read_dictionary(spark, layout).columns == sorted(MARRIAGES.text_features)
    assert spark.read.parquet(layout.raw).schema["es_divorcio"].dataType == T.IntegerType()

    etl.export_split(spark, layout, MARRIAGES, str(tmp_path / "csv"))
    schema = T.StructType.fromDDL("row_id long, es_divorcio int")
    labels = read_csv(spark, str(tmp_path / "csv/test/y_test"), schema)
    assert {tuple(r) for r in labels.collect()} == {tuple(r) for r in test.select("row_id", "es_divorcio").collect()}
    assert read_csv(spark, str(tmp_path / "csv/train/X_train"), train.drop("es_divorcio").schema).count() == 1050

    store = Store(spark, str(tmp_path / "store"))
    run = etl.log_run(store, "etl", layout, MARRIAGES)
    samples = [spark.read.parquet(f"{store.root}/artifacts/{run}/{side}") for side in ("raw", "clean")]
    ids = [{r.row_id for r in s.select("row_id").collect()} for s in samples]
    assert len(ids[0]) == 100 and ids[0] == ids[1]


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("extra,b,a\nx,2.0,1\ny,3,\\N\n")
    assert [tuple(r) for r in read_named(spark, str(path), ["a", "b"]).collect()] == [("1", "2.0"), (None, "3")]
    with pytest.raises(ValueError, match="c"):
        read_named(spark, str(path), ["a", "c"])
    assert read_named(spark, str(path), ["key", "a"], optional=("key",)).columns == ["a"]


def test_flow_over_a_file_without_a_key(spark, tmp_path):
    raw = fixtures.raw_marriages(spark, "/root/testdata/sf0.001").limit(200)
    write_csv(raw.drop("row_id").withColumn("other", F.lit("x")).select("other", *reversed(raw.columns[1:])), str(tmp_path / "in"))
    layout = etl.Layout(str(tmp_path / "work"))
    etl.run(spark, str(tmp_path / "in"), layout, MARRIAGES, DESCRIBED_CATEGORIES, 42)
    keys = spark.read.parquet(layout.raw).select("row_id")
    assert keys.distinct().count() == 200
    assert spark.read.parquet(layout.split).join(keys, "row_id").count() == 200


def test_null_keys_are_paired(spark):
    from quipu.operators import align

    left = spark.createDataFrame([(1, "a"), (None, "b")], "k long, x string")
    right = spark.createDataFrame([(None, "d"), (1, "c")], "k long, y string")
    assert sorted(align.concat_columns(left, right, ["k"]).collect(), key=str) == [(1, "a", "c"), (None, "b", "d")]


def test_description_of_many_values(spark, tmp_path):
    """More bytes of values than a document is made for, and a document of the older form."""
    from quipu.operators import encode
    from quipu.plans import etl
    from quipu.schema import TEXT, Field, Table
    from quipu.sources.dictionary import read_categories, read_entries, write_entries

    spec = Table(fields=(Field("x", TEXT), Field("y", TEXT)), target="t", key="id")
    raw = spark.range(80_000).select("id", F.concat(F.repeat(F.lit("\u00e9 \""), 300), F.col("id")).alias("x"), (F.col("id") % 3).cast("string").alias("y"), F.lit(1).alias("t"))
    dictionary = encode.fit_dictionary(raw, ["x", "y"])
    assert dictionary.sizes["x"][1] > 64 << 20
    path = str(tmp_path / "d")
    write_entries(etl.describe(raw, raw, dictionary, spec, ["x", "y"], F.current_timestamp(), str(tmp_path / "pages")), path)
    assert sum(len(r.value) for r in read_entries(spark, path).collect()) < 10_000
    found = read_categories(spark, path, etl.CATEGORIES)
    assert {r["column"]: r["n"] for r in found.groupBy("column").agg(F.count_distinct("value").alias("n")).collect()} == {"x": 80_000, "y": 3}
    assert found.where("column = 'x'").join(raw, found["value"] == raw["x"], "left_anti").isEmpty()

    old = str(tmp_path / "old")
    spark.createDataFrame([('{"' + etl.CATEGORIES + '":{"a":["1","\u00f1"],"b":[]},"columns":["a"]}',)], "value string").coalesce(1).write.text(old)
    assert sorted(map(tuple, read_categories(spark, old, etl.CATEGORIES).collect())) == [("a", "1"), ("a", "\u00f1")]
