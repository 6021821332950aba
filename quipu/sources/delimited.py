"""Delimited text with a header, on any path Spark can open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# One spelling for null and another for empty text, so that a round trip keeps
# both; Spark's defaults would read either as null.
NULL_TEXT = "\\N"
EMPTY_TEXT = '""'


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_text: str = NULL_TEXT,
    **options: str,
) -> DataFrame:
    """Read with a declared schema; a malformed row stops the job.

    Records must not contain line breaks unless ``multiLine`` is passed: a
    multi-line file cannot be split between tasks.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("nullValue", null_text)
        .option("escape", '"')
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.csv(path)


def read_named(
    spark: SparkSession, path: str, columns: list[str], optional: tuple[str, ...] = (), null_text: str = NULL_TEXT, **options: str
) -> DataFrame:
    """The named columns as text, found by the header; other columns are not read.

    The file may hold any further columns in any order.  A missing column is an
    error unless it is optional; files of one folder must have the same header.
    """
    header = spark.read.option("header", True).options(**options).csv(path).schema
    absent = [c for c in columns if c not in header.names and c not in optional]
    if absent:
        raise ValueError(f"no columns {absent} in {path}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header.names])
    return read_csv(spark, path, schema, null_text, **options).select(*[c for c in columns if c in header.names])


def write_csv(df: DataFrame, path: str, null_text: str = NULL_TEXT, mode: str = "overwrite") -> None:
    """Write one file per partition, each with a header and without an index."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("nullValue", null_text)
        .option("emptyValue", EMPTY_TEXT)
        .option("escape", '"')
        .csv(path)
    )
