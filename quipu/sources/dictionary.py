"""The data dictionary: named entries of JSON text, kept as one JSON document.

Lists of very many values do not belong in a document.  They are kept in pages, rows of some
thousand values each, and the document holds where the pages are and how many values.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.session import local_frame

ENTRIES = "key string, value string"


def entries(df: DataFrame, **values: Column) -> DataFrame:
    """One row of named columns as ``(key, value)`` rows of JSON text."""
    row = df.select(*[v.alias(k) for k, v in values.items()])
    texts = [
        (F.to_json(_scalar(f.name)) if isinstance(f.dataType, T.AtomicType) else F.to_json(f.name)).alias(f.name)
        for f in row.schema
    ]
    return row.select(*texts).unpivot([], row.columns, "key", "value")


def _scalar(name: str) -> Column:
    """A single value in the form that JSON functions take."""
    return F.col(name).cast("variant")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a stored document; none when there is no document."""
    try:
        documents = spark.read.option("wholetext", True).text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_frame(spark, [], ENTRIES)
    parsed = documents.select(F.parse_json("value").alias("document"))
    exploded = parsed.lateralJoin(spark.tvf.variant_explode(F.col("document").outer()))
    return exploded.select("key", F.to_json("value").alias("value"))


def write_entries(df: DataFrame, path: str) -> None:
    """Write the entries, sorted by name, as one JSON document.

    There is one row per name of the document, not per row of the data.
    """
    lines = F.sort_array(F.collect_list(F.concat(F.to_json(_scalar("key")), F.lit(":"), F.col("value"))))
    document = df.agg(F.concat(F.lit("{"), F.array_join(lines, ","), F.lit("}")).alias("value"))
    document.coalesce(1).write.mode("overwrite").text(path)


def quoted(text: Column) -> Column:
    """A text as JSON."""
    return F.to_json(text.cast("variant"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Write ``(column, page, values)`` rows to a new folder, one JSON line each."""
    pages.write.partitionBy("column").json(path)


def read_categories(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """``(column, value)`` for all values an entry lists, in the document itself or in pages it points to."""
    found = read_entries(spark, path).where(F.col("key") == entry).select(F.parse_json("value").alias("v"))
    listed = found.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("key").alias("column"), F.col("value").alias("told"))
    is_list = F.schema_of_variant("told").startswith("ARRAY")
    values = F.from_json(F.to_json("told"), "array<string>")
    inline = listed.where(is_list).select("column", F.explode(values).alias("value"))
    pointer = F.from_json(F.to_json("told"), "pages string, values bigint")
    # One row per column that has pages.
    folders = {r["pages"] for r in listed.where(~is_list).select(pointer.alias("p")).select("p.pages").collect()}
    for folder in sorted(folders):
        pages = spark.read.schema("page bigint, values array<string>, column string").json(folder)
        inline = inline.unionByName(pages.select("column", F.explode("values").alias("value")))
    return inline
