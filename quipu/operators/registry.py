"""Rules over run logs, model versions and aliases, as table operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.joins import lookup_join
from quipu.operators.metrics import METRICS
from quipu.operators.ordered import ROWS_PER_RANGE, numbered
from quipu.session import materialize

NO_STAGE = "None"


def merge_entries(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old and new entries; where both have a key, the new one stands."""
    values = [c for c in new.columns if c not in key]
    tagged = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    merged = tagged.groupBy(*key).agg(F.max_by(F.struct(*values), "_new").alias("_v"))
    return merged.select(*key, "_v.*")


def absent_from(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``new`` whose key ``old`` does not have, one per key.

    Rows of one key collapse to the least of them before the shuffle, so neither
    a repeated key nor a large old table makes a large task.
    """
    rest = [c for c in new.columns if c not in key]
    pick = F.min(F.struct(*rest)).alias("_v") if rest else F.lit(None).alias("_v")
    once = new.groupBy(*key).agg(pick)
    known = old.select(*[F.col(k).alias(f"_of_{k}") for k in key]).distinct()
    # A null is a key like any other: it is inserted once.
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key])
    missing = once.join(known, same, "left_anti")
    return missing.select(*key, *([f"_v.{c}" for c in rest]))


def insert_if_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old``, and the rows of ``new`` under keys it does not have."""
    return old.unionByName(absent_from(new, old, key))


def assign_versions(
    new: DataFrame,
    existing: DataFrame,
    order: str,
    name: str = "name",
    version: str = "version",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number new versions per name, on from the highest existing one."""
    placed = numbered(new, order, [name], "_place", rows_per_range)
    highest = materialize(existing.groupBy(name).agg(F.max(version).alias("_highest")), "highest-versions")
    joined = lookup_join(placed, highest, [name])
    number = F.coalesce(F.col("_highest"), F.lit(0)) + F.col("_place")
    return joined.select(*new.columns, number.cast("int").alias(version))


def latest_version(versions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """The newest version of each model among those in no stage."""
    unstaged = versions.filter(F.col("stage") == NO_STAGE)
    rest = [c for c in versions.columns if c != name]
    newest = unstaged.groupBy(name).agg(F.max_by(F.struct(*rest), version).alias("_v"))
    return newest.select(name, "_v.*").select(*versions.columns)


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The standing version of each name and alias: the one promoted last."""
    order = F.struct("promoted_at", "version")
    standing = aliases.groupBy("name", "alias").agg(F.max_by(F.struct("version", "promoted_at"), order).alias("_v"))
    return standing.select("name", "alias", "_v.*")


def resolve_alias(aliases: DataFrame, versions: DataFrame, alias: str | Column) -> DataFrame:
    """``(name, alias, version, source, run_id)`` of what an alias stands for.

    Version numbers may be text in either table; they are compared as integers.
    """
    standing = current_aliases(aliases.withColumn("version", F.col("version").cast("int")))
    wanted = standing.filter(F.col("alias") == alias).select("name", "alias", "version")
    known = versions.select("name", F.col("version").cast("int").alias("version"), "source", "run_id")
    return wanted.join(known, ["name", "version"]).select("name", "alias", "version", "source", "run_id")


def challenge(
    predictions: DataFrame, label: str, champion: str, challenger: str, metric: str = "accuracy"
) -> DataFrame:
    """One row: the scores of both models on the same rows, and who wins."""
    score = METRICS[metric]
    return decide(
        predictions.agg(
            score(label, champion).alias("champion_score"),
            score(label, challenger).alias("challenger_score"),
        )
    )


def decide(scores: DataFrame) -> DataFrame:
    """The challenger must be strictly better; on a tie the champion stays.

    A null champion score means that there is no champion.
    """
    better = F.col("champion_score").isNull() | (F.col("challenger_score") > F.col("champion_score"))
    promote = F.col("challenger_score").isNotNull() & better
    return scores.withColumn("promote", promote).withColumn(
        "winner", F.when(F.col("promote"), "challenger").otherwise("champion")
    )
