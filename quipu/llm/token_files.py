"""Token ids as binary files: frequency ranks in byte-aligned codes beside control bytes.

A file holds blocks; a block holds documents in ascending id order:

    magic, bits per id in the control bytes, documents, null ids, control bytes, data bytes
    document ids (int64), ids per document (uint32), control bytes, data bytes, newline

The most frequent ids have the smallest ranks, so that most take one byte.  A control
byte tells the lengths of the next eight codes (one or two bytes each, vocabularies up
to 65,536) or of the next four (one to four bytes each).  Each document starts a control
byte of its own.  Numbers are little-endian.  Readers look lengths up by control byte.

Null and empty texts consist of the end id alone.  Rows that repeat an id each get their
own place, in the order of their ids' bytes.  Documents without an id come first; their
id is written as 0, and a block says how many of its first documents they are.  An empty table gives no file and no row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import bpe, scan
from quipu.session import materialize

MAGIC = b"QTOK"
HEAD = "<4sBIIQQ"
HEAD_SIZE = struct.calcsize(HEAD)
FILE_TEXT_BYTES = 16 << 20
BLOCK_IDS = 1 << 19


def lengths_table(bits: int) -> np.ndarray:
    """For each control byte, the lengths of the codes that it describes."""
    per = 8 // bits
    shifts = np.arange(per) * bits
    return ((np.arange(256)[:, None] >> shifts) & ((1 << bits) - 1)).astype(np.int64) + 1


def control_bits(vocabulary: int) -> int:
    return 1 if vocabulary <= 1 << 16 else 2


def pack(ranks: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of one document's ranks."""
    per = 8 // bits
    size = np.ones(len(ranks), dtype=np.int64)
    for limit in (1 << 8, 1 << 16, 1 << 24)[: (1 << bits) - 1]:
        size += ranks >= limit
    codes = np.zeros(-(-len(ranks) // per) * per, dtype=np.uint8)
    codes[: len(ranks)] = size - 1
    control = np.bitwise_or.reduce(codes.reshape(-1, per) << (np.arange(per, dtype=np.uint8) * bits), axis=1).astype(np.uint8)
    if bits == 1:
        spread = np.ascontiguousarray(ranks, dtype="<u2").view(np.uint8).reshape(-1, 2)
    else:
        spread = np.ascontiguousarray(ranks, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), spread[np.arange(spread.shape[1]) < size[:, None]].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """The ranks of consecutive documents."""
    per = 8 // bits
    sections = -(-counts // per)
    size = lengths_table(bits)[control].ravel()
    size = size[scan.ragged((np.cumsum(sections) - sections) * per, counts)]
    start = np.cumsum(size) - size
    padded = np.concatenate([data, np.zeros(4, dtype=np.uint8)]).astype(np.uint32)
    ranks = padded[start]
    for k in range(1, 1 << bits):
        ranks |= np.where(size > k, padded[start + k] << np.uint32(8 * k), np.uint32(0))
    return ranks


def token_order(words: bpe.Words, vocabulary: int, extra: dict[int, int]) -> np.ndarray:
    """Ids from the most to the least frequent, ties by id; never more than the vocabulary."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for token, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[scan.unpress_numbers(token)] += scan.unpress(count, np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = words.encoded.select("tokens", "totals").where("tokens is not null").mapInArrow(add, "id long, n long")
    total = np.zeros(vocabulary, dtype=np.int64)
    for id, n in counts.groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[id] = n
    for id, n in extra.items():
        total[id] += n
    return np.lexsort((np.arange(vocabulary), -total)).astype("<u4")


def _coder(rank: np.ndarray, end_id: int, cuts: list[int], bits: int):
    """One row for the documents of a block that belong to the same file, packed together."""

    def run(documents: pa.Table) -> pa.Table:
        ids, named = scan.numbers(documents.column("doc_id").combine_chunks())
        counts, controls, packed = [], [], []
        for _, _, data, borders in scan.slices(documents.column("ids")):
            flat = rank[np.frombuffer(data.tobytes(), dtype="<u4")]
            for a, b in zip((borders[:-1] // 4).tolist(), (borders[1:] // 4).tolist()):
                control, coded = pack(np.append(flat[a:b], rank[end_id]), bits)
                counts.append(b - a + 1)
                controls.append(len(control))
                packed.append(control + coded)
        part = np.where(named, np.searchsorted(cuts, ids, side="right"), 0).astype(np.int32)
        rows = []
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            sizes = [np.array([of[i] for i in own], dtype="<u4") for of in (counts, controls, list(map(len, packed)))]
            whole = np.frombuffer(b"".join(packed[i] for i in own), dtype=np.uint8)
            rows.append((int(p), scan.press_arrays(named[own].astype("u1"), ids[own].astype("<i8"), *sizes, whole)))
        columns = list(zip(*rows)) if rows else [[], []]
        scan.release()
        return pa.table({"part": pa.array(columns[0], pa.int32()), "packed": pa.array(columns[1], pa.binary())})

    return run


def _blocks(bits: int, block_ids: int):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        pieces = [scan.unpress_arrays(packed) for packed in table.column("packed").to_pylist()]
        named, ids, counts, controls, sizes, whole = (np.concatenate(column) for column in zip(*pieces))
        del pieces
        begin = np.cumsum(sizes, dtype=np.int64) - sizes
        order = _in_order(named, ids, counts, controls, begin, sizes, whole)
        ends = np.cumsum(counts[order], dtype=np.int64)
        out, a = [], 0
        while a < len(order):
            before = ends[a - 1] if a else 0
            b = int(np.searchsorted(ends, before + block_ids, side="left")) + 1
            own = order[a : min(b, len(order))]
            control = whole[scan.ragged(begin[own], controls[own].astype(np.int64))]
            data = whole[scan.ragged(begin[own] + controls[own], sizes[own].astype(np.int64) - controls[own])]
            head = struct.pack(HEAD, MAGIC, bits, len(own), int((named[own] == 0).sum()), len(control), len(data))
            out.append(b"".join([head, ids[own].astype("<i8").tobytes(), counts[own].astype("<u4").tobytes(), control.tobytes(), data.tobytes()]))
            a = b
        scan.release()
        return pa.table({"part": pa.array([part] * len(out), pa.int32()), "block": pa.array(out, pa.binary())})

    return run


def _in_order(named: np.ndarray, ids: np.ndarray, counts: np.ndarray, controls: np.ndarray, begin: np.ndarray, sizes: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Documents by id, those without one first; of one id by their lengths and bytes."""
    order = np.lexsort((controls, counts, ids, named))
    same = np.ones(len(order), dtype=bool)
    same[0:1] = False
    for column in (controls, counts, ids, named):
        same[1:] &= column[order][1:] == column[order][:-1]
    for run in np.split(np.arange(len(order)), np.flatnonzero(~same))[1:]:
        if len(run) > 1:
            own = order[run]
            order[run] = sorted(own.tolist(), key=lambda i: whole[begin[i] : begin[i] + sizes[i]].tobytes())
    return order


def write(
    docs: DataFrame, words_of: bpe.TokenizerFile, vocabulary: int, end_id: int, path: str, text: str = "text", id: str = "doc_id",
    file_text_bytes: int = FILE_TEXT_BYTES, block_ids: int = BLOCK_IDS, **limits: int,
) -> np.ndarray:
    """Write one file for each range of ids below ``path``; returns the ids by rank.

    Files go through Spark's writer, so that tasks may be repeated.  The ranges are cut
    by the texts' bytes; where they are cut decides nothing but the size of the files.
    """
    totals = docs.agg(F.sum(F.octet_length(F.col(text))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    words = bpe.encode_words(docs, words_of, text, id, count_tokens=True, **limits)
    words = bpe.Words(words.blocks, materialize(words.encoded, "bpe-words"))
    order = token_order(words, vocabulary, {end_id: totals["n"]})
    rank = np.empty(vocabulary, dtype="<u4")
    rank[order] = np.arange(vocabulary)
    files = max(1, -(-int(totals["b"] or 0) // file_text_bytes))
    key = F.col(id).cast("long")
    cuts = []
    if files > 1:
        cuts = docs.select(F.percentile_approx(key, F.lit([k / files for k in range(1, files)]), F.lit(10 * files))).first()[0] or []
    bits = control_bits(vocabulary)
    coded = words.documents(_coder(rank, end_id, cuts, bits), "part int, packed binary")
    blocks = coded.groupBy("part").applyInArrow(_blocks(bits, block_ids), "part int, block binary")
    blocks.select("part", F.col("block").cast("string").alias("value")).write.partitionBy("part").text(path)
    return order


def _parse(order: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), dtype=np.uint8)
                at = before = 0
                while at < len(data):
                    magic, bits, n, nulls, controls, size = struct.unpack(HEAD, data[at : at + HEAD_SIZE].tobytes())
                    if magic != MAGIC:
                        raise ValueError(f"no block at byte {at}")
                    at += HEAD_SIZE
                    ids = np.frombuffer(data[at : at + 8 * n].tobytes(), dtype="<i8")
                    counts = np.frombuffer(data[at + 8 * n : at + 12 * n].tobytes(), dtype="<u4").astype(np.int64)
                    at += 12 * n
                    ranks = unpack(data[at : at + controls], data[at + controls : at + controls + size], counts, bits)
                    at += controls + size + 1
                    borders = np.concatenate([[0], np.cumsum(counts)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, part.as_py(), dtype=np.int32)),
                            pa.array(ids, mask=np.arange(n) < nulls),
                            pa.array(before + borders[:-1]),
                            pa.array(counts),
                            scan.binary_column(order[ranks], borders * 4),
                        ],
                        names=["part", "doc_id", "start", "n_tokens", "ids"],
                    )
                    before += int(borders[-1])
                    del ranks
                scan.release()

    return run


def read(spark: SparkSession, path: str, order: np.ndarray) -> DataFrame:
    """``part``, ``doc_id``, ``start`` (within the part), ``n_tokens``, ``ids`` of every document in the files."""
    files = spark.read.format("binaryFile").load(path)
    part = F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part")
    return files.select(part, "content").mapInArrow(_parse(order), "part int, doc_id long, start long, n_tokens long, ids binary")


def checksums(documents: DataFrame) -> DataFrame:
    """Replace the ids by their CRC-32, and count ``start`` from the first id of all files."""
    summed = documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    rows = materialize(summed, "token-starts")
    sizes = sorted(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in sizes)])[:-1].tolist()
    spark = documents.sparkSession
    if not sizes:
        return rows.drop("part")
    base = spark.createDataFrame(pa.table({"part": pa.array([p for p, _ in sizes], pa.int32()), "base": pa.array(starts, pa.int64())}))
    joined = rows.join(F.broadcast(base), "part")
    return joined.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
