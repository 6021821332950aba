"""Pairing two tables by key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sides(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Rows per key on either side, counted before the shuffle."""
    one, none = F.lit(1).alias("_l"), F.lit(0).alias("_l")
    both = left.select(*key, one, F.lit(0).alias("_r")).unionByName(
        right.select(*key, none, F.lit(1).alias("_r"))
    )
    return both.groupBy(*key).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def alignment(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """One row: the rows of each side, keys on one side only, keys that repeat."""
    sides = _sides(left, right, key)
    report = sides.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") == 0)).alias("left_only"),
        F.count_if((F.col("_r") > 0) & (F.col("_l") == 0)).alias("right_only"),
        F.count_if((F.col("_l") > 1) | (F.col("_r") > 1)).alias("repeated"),
    )
    equal = F.col("left_rows") == F.col("right_rows")
    paired = (F.col("left_only") == 0) & (F.col("right_only") == 0) & (F.col("repeated") == 0)
    return report.withColumn("aligned", equal & paired)


def require_aligned(left: DataFrame, right: DataFrame, key: list[str]) -> None:
    report = alignment(left, right, key).first()
    if not report["aligned"]:
        raise ValueError(f"the tables are not aligned: {report.asDict()}")


def concat_columns(left: DataFrame, right: DataFrame, key: list[str], check: bool = True) -> DataFrame:
    """Features and target side by side, after the alignment check."""
    if check:
        require_aligned(left, right, key)
    # A null is a key like any other, as in the check.
    named = right.withColumnsRenamed({k: f"_of_{k}" for k in key})
    same = reduce(and_, [left[k].eqNullSafe(named[f"_of_{k}"]) for k in key])
    return left.join(named, same).drop(*[f"_of_{k}" for k in key])


def partition_check(whole: DataFrame, parts: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """One row: do the parts cover the whole, without overlap and without extras?

    Every side is counted per key in a single shuffle.
    """
    tagged = whole.select(*key, F.lit(1).alias("_w"), F.lit(0).alias("_p"))
    for part in parts.values():
        tagged = tagged.unionByName(part.select(*key, F.lit(0).alias("_w"), F.lit(1).alias("_p")))
    per_key = tagged.groupBy(*key).agg(F.sum("_w").alias("_w"), F.sum("_p").alias("_p"))
    report = per_key.agg(
        F.coalesce(F.sum("_w"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("_p"), F.lit(0)).alias("part_rows"),
        F.count_if(F.col("_p") == 0).alias("missing"),
        F.count_if(F.col("_p") > 1).alias("overlapping"),
        F.count_if(F.col("_w") == 0).alias("extra"),
    )
    good = (F.col("missing") == 0) & (F.col("overlapping") == 0) & (F.col("extra") == 0)
    return report.withColumn("is_partition", good)
