"""Documents linked by the Jaccard similarity of their word n-grams.

Words are the runs outside 0x20 and 0x09-0x0D, lower-cased in ASCII; a document's set
holds its distinct word n-grams, or its whole word sequence if that is shorter.  Equal
sets are collapsed first.  The n-grams of a set are ordered from the rarest to the most
frequent, and two sets can only be similar enough if their prefixes in that order share
one: prefixes meet by n-gram.  A pair found there must pass the length filter, the
positional filter and a suffix filter (common elements by hash range), and is then
verified once on the whole sets.

What is asked for is components, so a pair inside one component needs no second proof:
each n-gram's members first meet the member in which it stands earliest, and only what
then lies in different components meets the rest.

How often an n-gram occurs is counted over all documents in a table of fixed size; it
only orders the n-grams, so that sharing a cell costs time and no result.  N-grams are
told apart by 64-bit hashes.

Null and empty texts and texts without words have an empty set and are linked with
nothing.  Rows that repeat an id are one document for the links.  A row without an id gets
the component of its set.  An empty table gives an empty result.  Columns beside the id
and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm import scan
from quipu.llm.components import components
from quipu.llm.fuse import FuseFilter
from quipu.session import materialize

CELL_BITS = 18
RANGES = 32
PIVOTS = (1,)
SCREEN_KEYS = 1 << 25
PAIRS_AT_ONCE = 256


def _sets(column: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-gram hashes of the texts in ascending order, slice by slice, and where each text's begin."""
    for _, _, data, borders in scan.slices(column):
        _, _, hashes, begins = scan.word_hashes(data, borders)
        yield scan.unique_per_text(*scan.ngram_hashes(hashes, begins, n, whole_if_short=True))


def _frequencies(rows: DataFrame, n: int) -> np.ndarray:
    """In how many documents the n-grams of each cell occur; the table's size is fixed."""
    cells = 1 << CELL_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for codes, _ in _sets(batch.column(1), n):
                total += np.bincount((codes >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=cells)
            scan.release()
        used = np.flatnonzero(total)
        # Neighbouring cells go together: the shuffle has a row for 64 cells.
        whole = total.reshape(-1, 64)
        group = np.unique(used // 64)
        counts = pa.FixedSizeListArray.from_arrays(pa.array(whole[group].ravel()), 64).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(group), counts], names=["cells", "counts"])

    parts = rows.mapInArrow(run, "cells long, counts array<long>")
    sums = parts.groupBy("cells").agg(*[F.sum(F.col("counts")[k]).alias(f"c{k}") for k in range(64)])
    out = np.zeros((cells // 64, 64), dtype=np.int64)
    table = sums.toArrow()
    if table.num_rows:
        out[table.column(0).to_numpy()] = np.stack([table.column(k + 1).to_numpy() for k in range(64)], axis=1)
    return out.ravel()


def _prefixes(frequency: np.ndarray, n: int, num: int, den: int):
    names = ["doc_id", "n_shingles", "digest", "prefix", "ranges"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prefixes, ranges, sizes = [], [], [], []
            for codes, begins in _sets(batch.column(1), n):
                count = frequency[(codes >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
                rare = codes[np.lexsort((codes, count, text))]
                size = np.diff(begins)
                spread = np.bincount(text * RANGES + (codes & np.uint64(RANGES - 1)).astype(np.int64), minlength=len(size) * RANGES)
                ranges.append(spread.reshape(-1, RANGES))
                sizes.append(size)
                length = size - -(-size * num // den) + 1
                for a, b, k in zip(begins[:-1].tolist(), begins[1:].tolist(), length.tolist()):
                    digests.append(hashlib.blake2b(codes[a:b].tobytes(), digest_size=16).digest())
                    prefixes.append(rare[a : min(a + k, b)].astype("<u8").tobytes())
            if sizes:
                spread = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(ranges).ravel(), pa.int32()), RANGES)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.concatenate(sizes), pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(prefixes, pa.binary()),
                        spread.cast(pa.list_(pa.int32())),
                    ],
                    names=names,
                )
            del batch, digests, prefixes, ranges, sizes
            scan.release()

    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [np.frombuffer(p, dtype="<i8") for p in batch.column(2).to_pylist()]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        if not len(sizes):
            continue
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(data)),
                pa.array(np.repeat(batch.column(0).to_numpy(), sizes)),
                pa.array(np.repeat(batch.column(1).to_numpy(), sizes)),
                pa.array(scan.ragged(np.zeros(len(sizes), dtype=np.int64), sizes)),
            ],
            names=["gram", "rep", "size", "pos"],
        )


def _similar(num: int, den: int, n: int):
    """Pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for a in range(0, batch.num_rows, PAIRS_AT_ONCE):
                some = batch.slice(a, PAIRS_AT_ONCE)
                left = [s for part in _sets(some.column(2), n) for s in np.split(part[0], part[1][1:-1])]
                right = [s for part in _sets(some.column(3), n) for s in np.split(part[0], part[1][1:-1])]
                for k, (x, y) in enumerate(zip(left, right)):
                    common = len(x) + len(y) - len(np.union1d(x, y))
                    keep[a + k] = den * common >= num * (len(x) + len(y) - common)
            scan.release()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _screened(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given ids; other rows are mostly dropped before the shuffle.

    A filter of the ids goes to all tasks if there are few enough of them to bound its
    size; with more ids all rows are shuffled.
    """
    if ids.count() <= SCREEN_KEYS:

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = [b.column(0).to_numpy() for b in batches]
            if keys:
                made = FuseFilter.build(np.concatenate(keys).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array([made.to_bytes()], pa.binary())], names=["cells"])

        parts = [bytes(r[0]) for r in ids.mapInArrow(build, "cells binary").collect()]

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = [FuseFilter.from_bytes(p) for p in parts]
            for batch in batches:
                keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64)
                keep = np.zeros(len(keys), dtype=bool)
                for f in filters:
                    keep |= f.contains(keys)
                yield batch.filter(pa.array(keep))
                del batch
                scan.release()

        rows = rows.mapInArrow(sift, rows.schema)
    return rows.join(ids, rows.columns[0], "left_semi")


def _passes(num: int, den: int, size: str, pos: str, other: str, other_pos: str) -> Column:
    """Length and positional filter of two members of an n-gram."""
    least, most = F.least(size, other), F.greatest(size, other)
    rest = F.least(F.col(size) - F.col(pos), F.col(other) - F.col(other_pos))
    return (least * den >= most * num) & (rest * (num + den) >= (F.col(size) + F.col(other)) * num)


def classes(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, text: str = "text", id: str = "doc_id", pivots: tuple[int, ...] = PIVOTS
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two documents link when ``den`` times their common n-grams is at least ``num`` times
    their united ones; the component's id is the smallest id in it.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    frequency = _frequencies(rows, n)
    schema = "doc_id long, n_shingles long, digest binary, prefix binary, ranges array<int>"
    sets = materialize(rows.mapInArrow(_prefixes(frequency, n, num, den), schema), "ngram-sets")
    known = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("prefix").alias("prefix"), F.first("ranges").alias("ranges")
    )
    reps = materialize(reps, "ngram-classes")
    members = reps.select("rep", "size", "prefix").mapInArrow(_explode, "gram long, rep long, size long, pos long")
    shared = members.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    members = materialize(members.join(shared, "gram"), "prefixes")

    # Texts of all that may need a proof.
    texts = materialize(_screened(rows, members.select(F.col("rep").alias("doc_id")).distinct()), "ngram-texts")
    ranges = reps.select("rep", "size", "ranges")

    proved: DataFrame | None = None
    tried: DataFrame | None = None
    labels: DataFrame | None = None
    for pivot in (*pivots, 0):
        open_members = _open(members, labels)
        if open_members.isEmpty():
            break
        pairs = _candidates(open_members, pivot, num, den)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(_suffix(pairs, ranges, num, den), "candidates")
        left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        links = both.select("a", "b", "text_a", "text_b").mapInArrow(_similar(num, den, n), "a long, b long")
        proved = materialize(links if proved is None else proved.unionByName(links), "proved")
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = components(proved)

    out = sets.select("doc_id", "n_shingles", "digest").join(reps.select("digest", "rep"), "digest", "left")
    if labels is not None:
        out = out.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members, with their components, of n-grams that still hold several components."""
    if labels is None:
        return members.withColumn("component", F.col("rep"))
    named = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    several = named.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return materialize(named.join(several.select("gram"), "gram"), "open-prefixes")


def _candidates(members: DataFrame, pivots: int, num: int, den: int) -> DataFrame:
    """Pairs of different components that share a prefix n-gram and pass length and position.

    With ``pivots`` each n-gram's members meet so many of them at most; with none, all
    members outside the n-gram's largest component meet all others.
    """
    told = [F.col("size").alias("other_size"), F.col("pos").alias("other_pos"), F.col("rep").alias("other"), F.col("component").alias("other_component")]
    if pivots:
        lot = F.pmod(F.xxhash64("rep", F.lit(pivots)), F.lit(pivots))
        first = F.min(F.struct("pos", "size", "rep", "component")).alias("p")
        near = members.groupBy("gram", lot.alias("lot")).agg(first).select("gram", "p.*").select("gram", *told)
    else:
        sizes = members.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("n"))
        main = sizes.groupBy("gram").agg(F.max(F.struct("n", "component")).alias("m")).select("gram", F.col("m.component").alias("main"))
        near = members.join(main, "gram").where("component <> main").select("gram", *told)
    met = members.join(near, "gram").where((F.col("component") != F.col("other_component")) & _passes(num, den, "size", "pos", "other_size", "other_pos"))
    return met.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _suffix(pairs: DataFrame, ranges: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sets have enough elements in the same hash ranges to be similar."""
    a = ranges.select(F.col("rep").alias("a"), F.col("size").alias("size_a"), F.col("ranges").alias("ranges_a"))
    b = ranges.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), F.col("ranges").alias("ranges_b"))
    common = reduce(lambda x, y: x + y, [F.least(F.col("ranges_a")[k], F.col("ranges_b")[k]) for k in range(RANGES)])
    enough = common * (num + den) >= (F.col("size_a") + F.col("size_b")) * num
    return pairs.join(a, "a").join(b, "b").where(enough).select("a", "b").distinct()


def survivors(docs: DataFrame, text: str = "text", id: str = "doc_id", **limits) -> DataFrame:
    """The rows of each component's smallest id, with all their columns; rows without an id stay."""
    dropped = classes(docs, text=text, id=id, **limits).where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs[id].cast("long") == F.col("_dropped"), "left_anti")
