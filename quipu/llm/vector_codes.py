"""Vectors as short codes: product quantization on whole numbers, with exact nearest entries.

A component x becomes floor(scale * x); a vector is cut into equal consecutive parts, and
each part is replaced by the number of the nearest entry of that part's codebook.

The nearest entry is found by slices of sorted coordinates.  For every dimension the
entries are sorted once, and prefix masks tell, as bits, which entries come before each
place of that order; the exclusive or of two prefix masks is the set of entries within a
range.  A radius around a vector selects one range per dimension, and the intersection
of the masks leaves the entries within that box.  Only these are compared.  A best
distance within the radius proves itself, since no closer entry lies outside the box;
otherwise the radius grows to the distance found, or doubles where the box was empty.
The first radius follows from the distances found before, and decides nothing but speed.

Codebooks are fitted in rounds: a task assigns its vectors and keeps one sum per entry;
what reaches the driver is one row per entry, whatever the number of vectors.

Vectors that are null, that hold null or non-finite components, or whose length is not
the most frequent one that the number of parts divides (the shorter on a tie), are left
out.  Components beyond ``LIMIT`` in size count as ``LIMIT``, so that
sums of squares fit 64 bits.  Of repeated ids all rows count; ties in the order of ids
are told by the vectors, ties in distance by the lower entry.  An entry without parts
stays.  With fewer vectors than entries the codebooks are shorter.  An empty table gives
an empty result.  Other columns stay; those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.llm import scan
from quipu.session import materialize

LIMIT = 1 << 27
#: Names of columns made inside.
WHOLE, NO_LABEL, LABEL = "_quipu_whole", "_quipu_no_label", "_quipu_label"
CHUNK = 1 << 12


class Slices:
    """One codebook (entries x dimensions), ready to be searched."""

    def __init__(self, book: np.ndarray):
        entries, dims = book.shape
        self.book = book.astype(np.float64)
        self.exact_below = (1 << 25) / max(dims, 1) ** 0.5  # sums of squares of such numbers have less than 53 bits
        self.wide = np.abs(book).max(initial=0) >= self.exact_below
        order = np.argsort(book, axis=0, kind="stable")
        self.sorted = [np.ascontiguousarray(book[order[:, d], d]) for d in range(dims)]
        words = -(-entries // 64)
        self.prefix = []
        for d in range(dims):
            bit = np.zeros((entries + 1, words), dtype=np.uint64)
            e = order[:, d]
            bit[np.arange(1, entries + 1), e // 64] = np.uint64(1) << (e % 64).astype(np.uint64)
            self.prefix.append(np.bitwise_or.accumulate(bit, axis=0))
        self.norms = (self.book**2).sum(axis=1)
        between = self.norms[:, None] - 2 * self.book @ self.book.T + self.norms
        np.fill_diagonal(between, np.inf)
        apart = between.min(axis=1)
        self.radius = int(np.sqrt(max(np.median(apart[np.isfinite(apart)], axis=0), 0))) + 1 if np.isfinite(apart).any() else 1

    def inside(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Which entries lie within ``radius`` of each vector in every dimension, as masks."""
        found = None
        for d, (values, prefix) in enumerate(zip(self.sorted, self.prefix)):
            low = np.searchsorted(values, x[:, d] - radius, side="left")
            high = np.searchsorted(values, x[:, d] + radius, side="right")
            mask = prefix[high] ^ prefix[low]
            found = mask if found is None else found & mask
        return found

    def _distances(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Squared distances of all vectors to the given entries."""
        if self.wide or np.abs(x).max() >= self.exact_below:
            book = self.book[entries].astype(np.int64)
            return np.stack([((x - b) ** 2).sum(axis=1) for b in book], axis=1)
        wide = x.astype(np.float64)
        return ((wide**2).sum(axis=1)[:, None] - 2 * wide @ self.book[entries].T + self.norms[entries]).astype(np.int64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each vector, ties to the lower one, and its squared distance."""
        code, best = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        for a in range(0, len(x), CHUNK):
            part = x[a : a + CHUNK]
            open_rows = np.arange(len(part))
            radius = np.full(len(part), self.radius, dtype=np.int64)
            while len(open_rows):
                rows, r = part[open_rows], radius[open_rows]
                mask = self.inside(rows, r)
                some = np.bitwise_or.reduce(mask, axis=0)
                entries = np.flatnonzero(np.unpackbits(some.view(np.uint8), bitorder="little"))
                if not len(entries):
                    radius[open_rows] *= 2
                    continue
                candidate = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, entries].astype(bool)
                distance = self._distances(rows, entries)
                distance[~candidate] = np.iinfo(np.int64).max
                at = distance.argmin(axis=1)
                least = distance[np.arange(len(rows)), at]
                code[a + open_rows], best[a + open_rows] = entries[at], least
                met = candidate.any(axis=1)
                proven = met & (least <= r * r)
                radius[open_rows] = np.where(met, np.ceil(np.sqrt(np.where(met, least, 0).astype(np.float64))).astype(np.int64) + 1, 2 * r)
                open_rows = open_rows[~proven]
            self.radius = max(1, int(np.sqrt(np.percentile(best[a : a + CHUNK], 95))) + 1)
        return code, best


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, number and position within the part; what whole numbers were made with."""

    entries: np.ndarray
    scale: int
    length: int

    def sha256(self) -> str:
        """Digest of all entries as decimal numbers, by part, number and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _whole(rows: DataFrame, vector: str, parts: int, scale: int) -> DataFrame:
    """Add the components as whole numbers; rows without a usable vector go."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    kept = rows.where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)).where(finite)
    limit = float(LIMIT)
    return kept.withColumn(WHOLE, F.transform(x, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(limit)), F.lit(-limit))).cast("int")))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def _sums(books: Codebooks):
    parts, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(b) for b in books.entries]
        total = np.zeros(books.entries.shape, dtype=np.int64)
        count = np.zeros(books.entries.shape[:2], dtype=np.int64)
        for batch in batches:
            whole = _matrix(batch.column(0), books.length)
            for p in range(parts):
                x = whole[:, p * width : (p + 1) * width]
                code, _ = search[p].nearest(x)
                count[p] += np.bincount(code, minlength=count.shape[1])
                np.add.at(total[p], code, x)
        part, entry = np.nonzero(count)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[part, entry].ravel()), width).cast(pa.list_(pa.int64()))
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    return run


def fit(rows: DataFrame, vector: str = "embedding", id: str = "vec_id", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Codebooks:
    """Codebooks that start from the vectors of the smallest ids and are refined in ``rounds``."""
    kept = _whole(rows.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{vector}`").alias("_vector")), "_vector", parts, scale).select("_id", WHOLE)
    order = [F.col("_id").asc_nulls_last(), F.col(WHOLE)]
    lengths = kept.groupBy(F.size(WHOLE).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").first()
    if usual is None:
        return Codebooks(np.zeros((parts, 0, 0), dtype=np.int64), scale, 0)
    length = usual["length"]
    kept = materialize(kept.where(F.size(WHOLE) == length), "vectors")
    start = np.array([r[0] for r in kept.orderBy(*order).limit(entries).select(WHOLE).collect()], dtype=np.int64)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2)), scale, length)
    for _ in range(rounds):
        width = books.entries.shape[2]
        found = kept.select(WHOLE).mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        found = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
        moved = books.entries.copy()
        for r in found.collect():
            moved[r["part"], r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(width)]
        books = Codebooks(moved, scale, length)
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """Replace the vector by ``code`` (the entries' numbers by part) and ``error`` (sum of squared distances)."""
    parts, _, width = books.entries.shape
    whole = _whole(rows, vector, parts, books.scale).where(F.size(WHOLE) == books.length)
    keep = [f for f in rows.schema.fields if f.name not in (vector, "code", "error")]
    held = whole.select(*[F.col(f"`{f.name}`") for f in keep], WHOLE)
    schema = T.StructType([*keep, T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(b) for b in books.entries]
        for batch in batches:
            x = _matrix(batch.column(len(keep)), books.length)
            found = [s.nearest(x[:, p * width : (p + 1) * width]) for p, s in enumerate(search)]
            codes = np.stack([code for code, _ in found], axis=1)
            code = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel(), pa.int32()), parts).cast(pa.list_(pa.int32()))
            error = pa.array(sum(d for _, d in found), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], code, error], names=[*[f.name for f in keep], "code", "error"])
        scan.release()

    return held.mapInArrow(run, schema)


def decode(rows: DataFrame, books: Codebooks, code: str = "code", out: str = "decoded") -> DataFrame:
    """Add the vectors that the codes stand for; a null code gives null."""
    held = rows.select(*[F.col(f"`{n}`") for n in rows.columns if n != out])
    schema = T.StructType([*held.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    at = held.columns.index(code)
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = batch.column(at).is_valid().to_numpy(zero_copy_only=False)
            codes = _matrix(batch.column(at).drop_null(), parts)
            vectors = (books.entries[np.arange(parts), codes] / books.scale).reshape(len(codes), -1)
            ends = np.concatenate([[0], np.cumsum(there * books.length)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.append(~there, False)), pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=schema.names)

    return held.mapInArrow(run, schema)


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_error``, the errors summed over rows of the same label, nulls together.

    Sums are made before the shuffle, so that a label of very many rows costs no more than
    others; the look-up is as large as the number of labels, and joined as such.
    """
    same = [F.col(f"`{label}`").isNull().alias(NO_LABEL), F.coalesce(F.col(f"`{label}`"), F.lit(0)).alias(LABEL)]
    sums = coded.groupBy(*same).agg(F.sum("error").alias("label_error"))
    return coded.select("*", *same).join(sums, [NO_LABEL, LABEL]).drop(NO_LABEL, LABEL)
