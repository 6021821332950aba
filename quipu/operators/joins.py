"""Look-up joins that stay safe when either side is large or skewed."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.session import materialize

# A look-up table is broadcast only after its rows and text were counted.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024

# A key is hot when it holds at least this share of the rows, so there are at most
# 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.001

# What a row of a broadcast table takes besides its values.
ROW_BYTES = 64

# So many look-ups in a row are one step of generated code.
JOINS_A_STEP = 4


def apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions; the code generated for what comes before and for what comes after is not one.

    Steps without a shuffle between them become one method, and the virtual machine never compiles
    one of more than 8,000 bytes: its rows are interpreted.  Nothing is merged by so high a number of
    partitions, and no row moves.
    """
    return df.coalesce(1 << 20)


def fits_broadcast(lookup: DataFrame) -> bool:
    """Count the rows of ``lookup`` and the bytes of all its columns."""
    size = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in lookup.columns),
        F.lit(0),
    )
    found = lookup.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return found["n"] <= BROADCAST_ROWS and found["b"] + ROW_BYTES * found["n"] <= BROADCAST_BYTES


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: list[str], small: bool | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Left join ``df`` to ``lookup``, whose rows are unique in ``on``.

    ``small`` says that the caller has checked the size of ``lookup``.  A small
    one is broadcast, any other goes through :func:`hot_key_join`.
    """
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return df.join(F.broadcast(lookup), on, "left")
    return hot_key_join(df, lookup, on, hot)


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """The keys with at least ``HOT_SHARE`` of the rows of ``df``, from pre-aggregated counts."""
    counts = materialize(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") >= max(2.0, HOT_SHARE * total)).drop("_n")


def hot_key_join(df: DataFrame, lookup: DataFrame, on: list[str], hot: DataFrame | None = None) -> DataFrame:
    """Left join to a large unique table when some keys of ``df`` are very frequent.

    The hot keys, counted on ``df`` unless the caller has them, are resolved by a
    broadcast of at most ``1 / HOT_SHARE`` rows.  The other rows meet the look-up in a
    shuffle, where no key is large; rows that are already resolved are dealt out evenly
    there, whatever they hold.
    """
    added = [c for c in lookup.columns if c not in on]
    hot = materialize(hot_keys(df, on) if hot is None else hot, "hot-keys")
    payload = F.struct(*added) if added else F.struct(F.lit(1).alias("_"))
    wide = lookup.select(*on, payload.alias("_found"))
    found = wide.join(F.broadcast(hot), on, "left_semi")
    hot = hot.join(F.broadcast(found), on, "left").select(
        *[F.col(c).alias(f"_hot_{c}") for c in on],
        F.col("_found").alias("_hot_found"),
        F.lit(True).alias("_is_hot"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on]
    marked = df.join(F.broadcast(hot), _all(same), "left")

    resolved = F.coalesce(F.col("_is_hot"), F.lit(False))
    for c in on:
        resolved = resolved | F.col(c).isNull()
    # Part of the shuffle key: the hash of the key, or of the row's number once it is resolved.
    place = F.when(resolved, F.xxhash64("_number")).otherwise(F.xxhash64(*on))
    cold = marked.withColumn("_number", F.monotonically_increasing_id()).select(
        *df.columns,
        "_is_hot",
        "_hot_found",
        *[F.when(~resolved, F.col(c)).alias(f"_cold_{c}") for c in on],
        place.alias("_place"),
    )
    right = wide.select(
        *[F.col(c).alias(f"_cold_{c}") for c in on],
        F.xxhash64(*on).alias("_place"),
        F.col("_found").alias("_cold_found"),
    )
    joined = cold.join(right, [*[f"_cold_{c}" for c in on], "_place"], "left")
    answer = F.when(F.col("_is_hot"), F.col("_hot_found")).otherwise(F.col("_cold_found"))
    return joined.select(*df.columns, *[answer[c].alias(c) for c in added])


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)
