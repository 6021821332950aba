"""Scoring requests: JSON text with the features under one object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.schema import Table

CORRUPT = "_corrupt"


def parse_requests(df: DataFrame, body: str, spec: Table, keep: list[str]) -> DataFrame:
    """Columns ``keep``, the typed features, and the raw text where it is bad.

    A field that is absent or of the wrong type becomes null, so that the
    required-field check can name it.  An integer may come as ``38``, ``38.0`` or
    ``"38"``.  Works the same on a stream.
    """
    whole = [f.name for f in spec.fields if isinstance(f.type, T.IntegralType)]
    fields = [T.StructField(f.name, T.StringType() if f.name in whole else f.type) for f in spec.fields]
    schema = T.StructType([T.StructField("features", T.StructType(fields)), T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(*keep, F.from_json(body, schema, options).alias("_request"))
    typed = [
        _integer(F.col(f"_request.features.{f.name}"), f.type).alias(f.name) if f.name in whole else F.col(f"_request.features.{f.name}")
        for f in spec.fields
    ]
    return parsed.select(*keep, *typed, F.col(f"_request.{CORRUPT}").alias(CORRUPT))


def _integer(text: Column, type_: T.DataType) -> Column:
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1)
    return F.when(digits != "", digits).try_cast(type_)


def to_request(spec: Table) -> Column:
    """The request text of a row of features, for replaying a table."""
    return F.to_json(F.struct(F.struct(*spec.features).alias("features")))
