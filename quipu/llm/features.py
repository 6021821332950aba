"""Presence of byte n-grams in whole texts, and bounded samples of rows to learn from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm import scan

PAIRS = 1 << 16
HASH_BITS = 17
PATTERN_WORDS = 8
SIZES = (256, PAIRS, 1 << HASH_BITS, 1 << PATTERN_WORDS)
STARTS = (0, 256, 256 + PAIRS, 256 + PAIRS + (1 << HASH_BITS))
WIDTH = sum(SIZES)

_mark = np.zeros(WIDTH, dtype=np.int64)


def presence(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct bytes, byte pairs and byte triples of one text.

    Bytes and pairs have codes of their own; triples are hashed.
    """
    wide = data.astype(np.uint32)
    pairs = wide[:-1] << np.uint32(8) | wide[1:]
    triples = (pairs[:-1] << np.uint32(8) | wide[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - HASH_BITS)
    found = []
    for start, codes in zip(STARTS, (wide, pairs, triples)):
        place = np.arange(len(codes))
        cells = codes.astype(np.int64) + start
        _mark[cells] = place  # the last occurrence stays
        found.append(cells[_mark[cells] == place])
    return tuple(found)


def repeats(data: np.ndarray, borders: np.ndarray) -> Iterator[np.ndarray]:
    """For each text, codes of its n-grams over the alphabet "the word before again" and "another word"."""
    _, _, hashes, begins = scan.word_hashes(data, borders, fold=False)
    again = np.zeros(len(hashes) + 1, dtype=np.int64)
    again[1:-1] = hashes[1:] == hashes[:-1]
    again[begins] = 0
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        bits = again[a:b]
        if len(bits) < PATTERN_WORDS:
            bits = np.concatenate([bits, np.zeros(PATTERN_WORDS - len(bits), dtype=np.int64)])
        codes = np.zeros(len(bits) - PATTERN_WORDS + 1, dtype=np.int64)
        for k in range(PATTERN_WORDS):
            codes = codes * 2 + bits[k : len(bits) - PATTERN_WORDS + 1 + k]
        yield STARTS[3] + np.flatnonzero(np.bincount(codes, minlength=1))


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Codes of all indicators of each text: byte n-grams and repeated words."""
    for _, _, data, borders in scan.slices(column):
        for a, b, again in zip(borders[:-1].tolist(), borders[1:].tolist(), repeats(data, borders)):
            yield np.concatenate([*presence(data[a:b]), again])


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text, one after the other."""
    for _, _, data, borders in scan.slices(column):
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            yield data[a:b]


def held_out(id: Column, modulus: int, remainder: int) -> Column:
    """Whether CRC-32 of the id as text has the remainder; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def sample_ids(rows: DataFrame, per_class: int) -> dict[int, list]:
    """For each class at most ``per_class`` ids, those with the smallest hashes.

    ``rows`` has ``doc_id`` and ``class``.  What comes to the driver is one count per
    class and about three times ``per_class`` ids of each.
    """
    counts = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    share = {c: min(1.0, (3 * per_class + 30) / n) for c, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    place = F.xxhash64("doc_id", F.lit(7)).cast("double") / float(1 << 64) + 0.5
    near = rows.withColumn("place", place).where(F.col("place") <= limits[F.col("class")])
    found: dict = {}
    for r in near.select("doc_id", "class", "place").distinct().collect():
        found.setdefault(r["class"], []).append((r["place"], r["doc_id"]))
    return {c: [id for _, id in sorted(rows)[:per_class]] for c, rows in sorted(found.items())}


def sample_features(docs: DataFrame, chosen: dict, text: str, id: str) -> list[tuple]:
    """Class and presence codes of the chosen documents, whose number is bounded."""
    spark = docs.sparkSession
    pairs = sorted((i, c) for c, ids in chosen.items() for i in ids)
    if not pairs:
        return []
    kind = pa.string() if isinstance(pairs[0][1], str) else pa.int64()
    known = spark.createDataFrame(pa.table({"_id": pa.array([p[0] for p in pairs], pa.int64()), "class": pa.array([p[1] for p in pairs], kind)}))
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.join(F.broadcast(known), "_id").select("_id", "class", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [c.astype("<u4").tobytes() for c in indicators(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], names=["id", "class", "codes"])

    found = rows.mapInArrow(run, f"id long, class {'string' if kind == pa.string() else 'long'}, codes binary").collect()
    found.sort(key=lambda r: (r["id"], bytes(r["codes"])))
    return [(r["class"], np.frombuffer(bytes(r["codes"]), dtype="<u4").astype(np.int64)) for r in found]
