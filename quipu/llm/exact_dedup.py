"""Exact duplicates over immutable snapshots and new batches.

A snapshot is a written table of distinct digests and one static binary-fuse filter for
each shard of it.  A new batch is first grouped by itself; its distinct digests are
screened by the filters, and only positives meet the snapshot's exact buckets.  Classes
of more than one row are then compared byte for byte; rows whose digests agree while
their texts differ are grouped by their texts instead.

A null text counts as empty.  Empty texts equal each other.  Repeated rows are rows of
their own.  Of equal texts the row with the largest id stays; when rows repeat that id,
all of them are marked as kept.  An empty table gives an empty result.  Columns beside
the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.fuse import FuseFilter
from quipu.session import materialize

SHARD_KEYS = 1 << 16
KEY = ["digest", "control"]


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


@dataclass(frozen=True)
class Snapshot:
    """Distinct digests of a batch, never changed again, with a filter per shard."""

    entries: DataFrame
    filters: DataFrame
    shards: int


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _keys(table: pa.Table) -> np.ndarray:
    digests = table.column("digest").to_pylist()
    return np.array([int.from_bytes(d[-8:], "little") for d in digests], dtype=np.uint64)


def _build(table: pa.Table) -> pa.Table:
    shard = table.column("shard")[0].as_py()
    return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([FuseFilter.build(_keys(table)).to_bytes()], pa.binary())})


def _screen(rows: pa.Table, filters: pa.Table) -> pa.Table:
    """The rows that a snapshot's filter does not rule out."""
    keep = np.zeros(rows.num_rows, dtype=bool)
    keys = _keys(rows)
    for cells in filters.column("cells").to_pylist():
        keep |= FuseFilter.from_bytes(cells).contains(keys)
    return rows.filter(pa.array(keep)).drop_columns(["shard"])


def snapshot(entries: DataFrame, shard_keys: int = SHARD_KEYS) -> Snapshot:
    """Freeze a batch's entries; the number of shards follows their count."""
    shards = max(1, -(-entries.count() // shard_keys))
    sharded = entries.select(_shard(shards).alias("shard"), "digest")
    filters = sharded.groupBy("shard").applyInArrow(_build, "shard int, cells binary")
    return Snapshot(entries, materialize(filters, "fuse-filters"), shards)


def positives(entries: DataFrame, old: Snapshot) -> DataFrame:
    """Keys of a batch's entries that pass the filter of the snapshot's shard."""
    rows = entries.select(_shard(old.shards).alias("shard"), *KEY)
    return (
        rows.groupBy("shard")
        .cogroup(old.filters.groupBy("shard"))
        .applyInArrow(_screen, "digest binary, control binary")
    )


def group_batch(rows: DataFrame) -> DataFrame:
    """Duplicates within one batch, collapsed before the shuffle."""
    return rows.groupBy(*KEY).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))


def classes(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    batches: int = 2,
    shard_keys: int = SHARD_KEYS,
    digest: Callable[[Column], Column] = sha256,
    control: Callable[[Column], Column] = md5,
) -> DataFrame:
    """``doc_id``, ``digest``, ``keep_id``, ``group_size`` of every row of ``docs``.

    The rows arrive as ``batches`` by a hash of their id: each batch is screened against
    the snapshots of all earlier ones, and then becomes a snapshot itself.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(id).cast("long").alias("doc_id"), whole.alias("text"))
    keyed = source.select("doc_id", digest(F.col("text")).alias("digest"), control(F.col("text")).alias("control"))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    rows = materialize(keyed.withColumn("batch", batch), "digests")

    frozen: list[Snapshot] = []
    for b in range(batches):
        homes = materialize(group_batch(rows.where(F.col("batch") == b)), f"entries-{b}").withColumn("home", F.lit(b))
        for old in frozen:
            met = positives(homes, old).join(old.entries.select(*KEY, F.col("home").alias("met")), KEY)
            homes = homes.join(met, KEY, "left").withColumn("home", F.least("home", "met")).drop("met")
        entries = materialize(homes.withColumn("batch", F.lit(b)), f"homes-{b}")
        frozen.append(snapshot(entries, shard_keys) if b + 1 < batches else Snapshot(entries, entries, 0))

    # An entry's home is the first batch that holds its digest, as the screening found it.
    every = frozen[0].entries
    for later in frozen[1:]:
        every = every.unionByName(later.entries)
    sums = every.groupBy(*KEY, "home").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    totals = materialize(every.select(*KEY, "home", "batch").join(sums, [*KEY, "home"]), "classes")
    found = rows.join(totals, [*KEY, "batch"]).select("doc_id", *KEY, "keep_id", "group_size")

    # Byte for byte: no digest may have two texts.  Copies collapse before the shuffle.
    spelled = source.select(digest(F.col("text")).alias("digest"), control(F.col("text")).alias("control"), "text", "doc_id")
    texts = spelled.select(*KEY, "text").distinct()
    clashing = materialize(texts.groupBy(*KEY).count().where("count > 1").select(*KEY), "clashes")
    if clashing.isEmpty():
        return found.select("doc_id", "digest", "keep_id", "group_size")
    clear = found.join(clashing, KEY, "left_anti")
    mixed = spelled.join(clashing, KEY, "left_semi")
    apart = mixed.groupBy(*KEY, "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    told = mixed.join(apart, [*KEY, "text"])
    columns = ["doc_id", "digest", "keep_id", "group_size"]
    return clear.select(*columns).unionByName(told.select(*columns))


def survivors(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    An id names one document, so rows that repeat a kept id and its text all stay.  A row
    without an id goes if its text has a row with one; else one row of the text stays.
    """
    found = classes(docs, text, id)
    kept = found.where("doc_id = keep_id").select("doc_id", "digest").distinct()
    same = (docs[id].cast("long") == kept["doc_id"]) & (sha256(F.coalesce(docs[text], F.lit(""))) == kept["digest"])
    nameless = docs.where(docs[id].cast("long").isNull())
    lone = found.where("keep_id IS NULL").select("digest").distinct()
    spelled = F.coalesce(docs[text], F.lit(""))
    left = nameless.select(F.struct("*").alias("row"), spelled.alias("spelled")).join(lone, sha256(F.col("spelled")) == lone["digest"], "left_semi")
    left = left.groupBy("spelled").agg(F.first("row").alias("row")).select("row.*")
    return docs.join(kept, same, "left_semi").unionByName(left)
