"""Range and presence checks that name the columns at fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.schema import Table
from quipu.sources.requests import CORRUPT


def out_of_range(spec: Table) -> Column:
    """The bounded columns whose value lies outside its inclusive range."""
    checks = []
    for field in spec.fields:
        column = F.col(field.name)
        if field.low is not None and field.high is not None:
            bad = ~column.between(field.low, field.high)
        elif field.low is not None:
            bad = column < field.low
        elif field.high is not None:
            bad = column > field.high
        else:
            continue
        checks.append(F.when(bad, F.lit(field.name)))
    return _names(checks)


def absent(spec: Table) -> Column:
    """The features that are null: not sent, or sent with the wrong type."""
    return _names([F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in spec.fields])


def _names(checks: list[Column]) -> Column:
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def check_ranges(df: DataFrame, spec: Table) -> DataFrame:
    return df.withColumn("violations", out_of_range(spec))


def check_required(df: DataFrame, spec: Table) -> DataFrame:
    """Add ``missing`` and ``valid``; a row with unreadable text is not valid."""
    readable = F.col(CORRUPT).isNull() if CORRUPT in df.columns else F.lit(True)
    return df.withColumn("missing", absent(spec)).withColumn("valid", readable & (F.size("missing") == 0))


def route(df: DataFrame, spec: Table) -> DataFrame:
    """Add ``missing``, ``violations`` and ``valid`` in one pass."""
    checked = check_ranges(check_required(df, spec), spec)
    return checked.withColumn("valid", F.col("valid") & (F.size("violations") == 0))
