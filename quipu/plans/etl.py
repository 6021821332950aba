"""From raw text to an encoded, described and split table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.text import DASHED
from quipu.operators.clean import bool_to_int, cast_types, clean, features_only
from quipu.operators.encode import Dictionary, encode, fit_dictionary, load_dictionary, save_dictionary
from quipu.operators.registry import merge_entries
from quipu.operators.split import paired_sample, train_test_split
from quipu.operators.stats import INLINE_BYTES, category_map, category_pages, inline_columns
from quipu.schema import FLAG, Table
from quipu.session import local_frame, materialize
from quipu.sources.delimited import read_named, write_csv
from quipu.sources.dictionary import entries, quoted, read_entries, write_entries, write_pages
from quipu.sources.store import Store


# The prefix of a run name, and the entry of the category values.
ETL_RUN = "ETL_run_"
CATEGORIES = "categories_values_per_categorical"


@dataclass(frozen=True)
class Layout:
    """Where the steps leave their tables."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def encoded(self) -> str:
        return f"{self.root}/encoded"

    @property
    def dictionary(self) -> str:
        return f"{self.root}/dictionary"

    @property
    def description(self) -> str:
        return f"{self.root}/description"

    @property
    def split(self) -> str:
        return f"{self.root}/split"


def encode_table(raw: DataFrame, spec: Table, null_policy: str = "error") -> tuple[DataFrame, Dictionary]:
    """Clean a raw table, fit the dictionary of its text columns, and encode it."""
    cleaned = clean(raw, spec, null_policy)
    dictionary = fit_dictionary(cleaned, spec.text_features)
    return encode(cleaned, dictionary, spec.text_features), dictionary


def describe(
    raw: DataFrame,
    encoded: DataFrame,
    dictionary: Dictionary,
    spec: Table,
    categories: list[str],
    moment: Column,
    pages: str,
    inline_bytes: int = INLINE_BYTES,
) -> DataFrame:
    """The data dictionary of a table before and after it was cleaned, as entries.

    The values come from the fitted dictionary; the tables give only their schemas.
    Columns of very many values are written as pages to the new folder ``pages``, to which
    their entry points; :func:`quipu.sources.dictionary.read_categories` reads both forms.
    """
    before = features_only(raw, spec.target).drop(spec.key)
    after = features_only(encoded, spec.target).drop(spec.key)
    inline = inline_columns(dictionary, categories, inline_bytes)
    told = category_map(dictionary, inline).select("column", F.to_json("values").alias("told"))
    paged = [c for c in categories if c not in inline]
    if paged:
        write_pages(category_pages(dictionary, paged), pages)
        pointers = [(c, pages, dictionary.sizes[c][0]) for c in paged]
        pointed = local_frame(raw.sparkSession, pointers, "column string, pages string, n bigint")
        told = told.unionByName(pointed.select("column", F.to_json(F.struct("pages", F.col("n").alias("values"))).alias("told")))
    # One entry per described column.
    # The names of the entries.
    named = F.transform(F.sort_array(F.collect_list(F.struct("column", "told"))), lambda c: F.concat(quoted(c["column"]), F.lit(":"), c["told"]))
    row = told.agg(F.parse_json(F.concat(F.lit("{"), F.array_join(named, ","), F.lit("}"))).alias("v"))
    return entries(
        row,
        columns=_names(before.columns),
        columns_after_clean=_names(after.columns),
        target_col=F.lit(spec.target),
        categorical_columns=_names(categories),
        columns_dtypes=_types(before),
        columns_dtypes_after_clean=_types(after),
        date=F.date_format(moment, DASHED),
        **{CATEGORIES: F.col("v")},
    )


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _types(df: DataFrame) -> Column:
    return F.create_map(*[F.lit(text) for pair in df.dtypes for text in pair])


def run(
    spark: SparkSession,
    source: str,
    layout: Layout,
    spec: Table,
    categories: list[str],
    seed: int,
    test_size: float = 0.3,
    null_policy: str = "error",
) -> None:
    """The whole flow over delimited text, each step leaving its table behind.

    Columns are found by the header's names, whatever else the file holds.  A file
    without the key gets one, fixed by the first table that is written.  Between our own steps the tables are Parquet, so that later steps read only
    the columns they need.  The split table is partitioned by ``split``: reading
    one side touches only its files.
    """
    raw = read_named(spark, source, [spec.key, *spec.features, spec.target], optional=(spec.key,))
    key = F.col(spec.key).cast("long") if spec.key in raw.columns else F.monotonically_increasing_id()
    raw = raw.select(key.alias(spec.key), *spec.features, spec.target)
    raw = bool_to_int(cast_types(raw, {spec.target: FLAG}))
    raw.write.mode("overwrite").parquet(layout.raw)
    raw = spark.read.schema(raw.schema).parquet(layout.raw)

    encoded, dictionary = encode_table(raw, spec, null_policy)
    encoded.write.mode("overwrite").parquet(layout.encoded)
    encoded = spark.read.schema(encoded.schema).parquet(layout.encoded)
    save_dictionary(dictionary, layout.dictionary)

    pages = f"{layout.description}-values/{uuid.uuid4().hex}"
    new = describe(raw, encoded, dictionary, spec, categories, F.current_timestamp(), pages)
    merged = merge_entries(read_entries(spark, layout.description), new, ["key"])
    # The document is read and replaced, so its new form is fixed first.
    write_entries(materialize(merged, "description"), layout.description)

    parts = train_test_split(encoded, [spec.key], seed, test_size, stratify=spec.target)
    parts.write.mode("overwrite").partitionBy("split").parquet(layout.split)


def read_split(spark: SparkSession, layout: Layout, part: str) -> DataFrame:
    return spark.read.parquet(layout.split).filter(F.col("split") == part).drop("split")


def read_dictionary(spark: SparkSession, layout: Layout) -> Dictionary:
    return load_dictionary(spark, layout.dictionary)


def export_split(spark: SparkSession, layout: Layout, spec: Table, folder: str) -> None:
    """Features and target of both parts as delimited text, each row with its key."""
    for part in ("train", "test"):
        rows = read_split(spark, layout, part)
        write_csv(rows.select(spec.key, *spec.features), f"{folder}/{part}/X_{part}")
        write_csv(rows.select(spec.key, spec.target), f"{folder}/{part}/y_{part}")


def log_run(store: Store, experiment: str, layout: Layout, spec: Table, rows: int = 100, seed: int = 42) -> str:
    """Log the run, with a sample of the same rows before and after cleaning."""
    spark = store.spark
    store.get_or_create_experiment(experiment)
    run_id = store.log_run(experiment, f"{ETL_RUN}{datetime.now():%Y/%m/%d-%H:%M:%S}", tags={"experiment": "etl"})
    raw, encoded = spark.read.parquet(layout.raw), spark.read.parquet(layout.encoded)
    before, after = paired_sample(raw, encoded, [spec.key], rows, seed)
    before.write.parquet(f"{store.root}/artifacts/{run_id}/raw")
    after.write.parquet(f"{store.root}/artifacts/{run_id}/clean")
    return run_id
