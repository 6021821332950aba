"""Small JSON documents in a folder: the data dictionary, model signatures."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.session import local_frame


def read_json_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a document; an absent one is empty, any other failure is raised."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def signature(df: DataFrame, features: list[str], output: str) -> DataFrame:
    """The input and output schema of a model, as one row of JSON text."""
    spark = df.sparkSession
    inputs = df.select(*features).schema
    outputs = df.select(output).schema
    return local_frame(spark, [(inputs.json(), outputs.json())], "inputs string, outputs string")


def signature_fields(signatures: DataFrame) -> DataFrame:
    """One row ``(side, name, type)`` per field of a signature."""
    texts = signatures.unpivot([], ["inputs", "outputs"], "side", "text")
    fields = F.from_json("text", "fields array<struct<name string, type string>>")["fields"]
    return texts.select("side", F.inline(fields))


def signature_schema(text: str) -> T.StructType:
    """The schema a signature text describes."""
    return T.StructType.fromJson(json.loads(text))
