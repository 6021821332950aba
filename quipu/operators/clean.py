"""Projection, casts, flags, nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.schema import Table


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns in the given order; a missing one is an error."""
    return df.select(*columns)


def cast_types(df: DataFrame, types: dict[str, T.DataType], on_error: str = "error") -> DataFrame:
    """Cast by a column-to-type map, in place; a missing column is an error.

    ``on_error="error"`` stops at a value that does not fit its type;
    ``"null"`` leaves a null for the validation step to find.  A number as text may
    have a fraction where an integer is wanted, which is cut off: ``3.0`` is 3.
    """
    if on_error not in ("error", "null"):
        raise ValueError(f"unknown error policy {on_error!r}")
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")

    def cast(name: str, type_: T.DataType) -> Column:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType) and isinstance(type_, T.IntegralType):
            number = column.cast("double") if on_error == "error" else column.try_cast("double")
            whole = number.cast(type_) if on_error == "error" else number.try_cast(type_)
            # A cast that fails costs an exception a row, so a text with a point is not tried as an integer, which it never is.
            plain = F.when(~F.contains(column, F.lit(".")), column.try_cast(type_))
            # A double has too few digits for large numbers, a decimal has enough for all that fit.
            return F.coalesce(plain, column.try_cast("decimal(38,18)").try_cast(type_), whole)
        return column.cast(type_) if on_error == "error" else column.try_cast(type_)

    return df.withColumns({name: cast(name, type_) for name, type_ in types.items()})


def bool_to_int(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """True and false as 1 and 0, for the named or for all boolean columns."""
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    if columns is not None:
        flags = [c for c in columns if c in flags]
    return df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def apply_null_policy(df: DataFrame, columns: list[str], policy: str = "error") -> DataFrame:
    """What to do with nulls: stop, write the text ``nan``, or keep them.

    The text form exists for text columns only; a null number stops the job
    under it, as a null has no integer form.
    """
    if policy == "keep":
        return df
    if policy not in ("error", "literal"):
        raise ValueError(f"unknown null policy {policy!r}")
    texts = set(text_columns(df))

    def checked(name: str) -> Column:
        if policy == "literal" and name in texts:
            return F.coalesce(F.col(name), F.lit("nan"))
        stop = F.raise_error(F.lit(f"null in column {name}"))
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(stop)

    return df.withColumns({c: checked(c) for c in columns})


def features_only(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def target_only(df: DataFrame, target: str) -> DataFrame:
    return df.select(target)


def clean(df: DataFrame, spec: Table, null_policy: str = "error") -> DataFrame:
    """Key, features in model order and the 0/1 target, all typed."""
    names = [*spec.features, spec.target]
    typed = cast_types(project(df, [spec.key, *names]), spec.types())
    return bool_to_int(apply_null_policy(typed, names, null_policy))
