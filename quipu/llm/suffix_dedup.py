"""Repeated byte strings across and within whole texts, by merging sorted suffix runs.

Every byte covered by a string of ``length`` bytes that also starts earlier (in a smaller
document id, or before in the same document) is removed; strings are judged on the input.

Suffixes are taken at anchors: the anchor of a window of ``length`` bytes is where its
least hashed ``anchor`` bytes begin, so equal windows have equal anchors at equal offsets,
and one suffix in some thirty is enough.  Texts are kept in blocks of some megabytes:

1. A block sends the hashes of its anchors, packed by bucket; a bucket says which of them
   occur more than once.
2. For those, the block sorts the strings from the anchors on (and before them), merges
   its own equal ones, and sends them front-coded as one sorted run per bucket.
3. A bucket merges the runs of all blocks by a loser tree that compares no byte of a known
   common prefix again, at most ``fan`` runs at a time and in as many levels as that
   takes; equal strings become one on every level.  Common prefixes to the right and left
   give each anchor's windows that occurred before.
4. Each block cuts its own texts.

Null and empty texts, and texts shorter than ``length``, lose nothing.  Rows that repeat an
id and text are one document and neither loses by the other; rows that repeat an id with
another text are compared by position, as within one document.  An empty table gives an
empty result.  Columns beside the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import scan, suffixes
from quipu.llm.tables import bucketed
from quipu.session import materialize

LENGTH = 100
ANCHOR = 32
BLOCK_BYTES = 4 << 20
FAN = 256

BLOCKS = "block long, bucket int, ids binary, payload binary"
RUNS = "block long, bucket int, payload binary"


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    types = {"block": pa.int64(), "bucket": pa.int32()}
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.binary())) for n, c in zip(names, columns)], names=list(names))


def _blocks(buckets: int, length: int, k: int, limit: int):
    names = ("block", "bucket", "ids", "payload")

    def finish(block: int, held: list[tuple]) -> pa.RecordBatch:
        ids, data, borders = (list(part) for part in zip(*held))
        sizes = np.concatenate([np.diff(b) for b in borders])
        whole = np.concatenate(data)
        rows = [(block, -1, np.concatenate(ids).astype("<i8").tobytes(), scan.press_arrays(sizes.astype("<u4"), whole))]
        hashes, counts = np.unique(suffixes.anchors(whole, np.concatenate([[0], np.cumsum(sizes)]), length, k)[3], return_counts=True)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        hashes, counts = hashes[order], counts[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            here = slice(cuts[b], cuts[b + 1])
            rows.append((block, int(b), None, scan.press_arrays(hashes[here], counts[here] > 1)))
        return _rows(rows, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            for a, b, data, borders in scan.slices(batch.column(1)):
                if held and size + len(data) > limit:
                    yield finish(block, held)
                    held, size, block = [], 0, block + 1
                    scan.release()
                held.append((ids[a:b], data.copy(), borders))
                size += len(data)
        if held:
            yield finish(block, held)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """For each block's hashes in a bucket, which occur more than once anywhere."""
    parts = [scan.unpress_arrays(p) for p in table.column("payload").to_pylist()]
    hashes, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.bincount(number, weights=1 + np.concatenate([p[1] for p in parts]), minlength=len(hashes))
    flags = (times > 1)[number]
    ends = np.cumsum([len(p[0]) for p in parts])
    masks = [scan.press_arrays(np.packbits(flags[e - len(p[0]) : e])) for p, e in zip(parts, ends)]
    return table.select(["block", "bucket"]).append_column("payload", pa.array(masks, pa.binary()))


def _text(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and borders of a block's documents."""
    ids = np.frombuffer(block.column("ids")[0].as_py(), dtype="<i8")
    sizes, data = scan.unpress_arrays(block.column("payload")[0].as_py())
    return ids, data, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _pack_run(right: np.ndarray, left: np.ndarray, right_size, left_size, id, position, place, block) -> bytes:
    """A sorted run: right and left strings front-coded, with where each first occurs."""
    shared, rest = suffixes.front_code(right, right_size)
    shared_left, rest_left = suffixes.front_code(left, left_size)
    numbers = [a.astype("<u4") for a in (right_size, left_size, place)]
    return scan.press_arrays(shared, rest, shared_left, rest_left, *numbers, id.astype("<i8"), position.astype("<i8"), block.astype("<i8"))


def _unpack_run(payload: bytes, length: int, k: int) -> dict[str, np.ndarray]:
    shared, rest, shared_left, rest_left, right_size, left_size, place, id, position, block = scan.unpress_arrays(payload)
    return {
        "right": suffixes.front_decode(shared, rest, right_size, length),
        "left": suffixes.front_decode(shared_left, rest_left, left_size, length - k),
        "shared": shared.astype(np.int64),
        "right_size": right_size.astype(np.int64),
        "left_size": left_size.astype(np.int64),
        "place": place.astype(np.int64),
        "id": id,
        "position": position,
        "block": block,
    }


def _intervals(block: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple]:
    """Rows of covered stretches, in a block's own positions, by block."""
    order = np.argsort(block, kind="stable")
    block, start, end = block[order], start[order], end[order]
    cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else [0]
    return [(int(block[a]), -1, scan.press_arrays(start[a:b].astype("<u4"), end[a:b].astype("<u4"))) for a, b in zip(cuts[:-1], cuts[1:])]


def _later_copies(right, left, right_size, left_size, id, position) -> np.ndarray:
    """Which rows equal one before them that starts earlier; equal rows stand together in that order."""
    same = np.zeros(len(right_size), dtype=bool)
    if len(same) > 1:
        same[1:] = (right_size[1:] == right_size[:-1]) & (left_size[1:] == left_size[:-1])
        same[1:] &= (right[1:] == right[:-1]).all(axis=1) & (left[1:] == left[:-1]).all(axis=1)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    return same & ((id != id[first]) | (position != position[first]))


def _runs(buckets: int, length: int, k: int):
    """A block's repeated anchors as sorted runs, and what its own equal strings cover."""

    def run(block: pa.Table, masks: pa.Table) -> pa.Table:
        name = block.column("block")[0].as_py()
        ids, data, borders = _text(block)
        anchor, first, last, hashes = suffixes.anchors(data, borders, length, k)
        rows: list[tuple] = []
        if len(anchor) and masks.num_rows:
            known = np.unique(hashes)
            bucket = (known % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            flags = np.zeros(len(known), dtype=bool)
            for b, mask in zip(masks.column("bucket").to_pylist(), masks.column("payload").to_pylist()):
                here = order[cuts[b] : cuts[b + 1]]
                flags[here] = np.unpackbits(scan.unpress_arrays(mask)[0], count=len(here)).astype(bool)
            keep = flags[np.searchsorted(known, hashes)]
            anchor, first, last, hashes = anchor[keep], first[keep], last[keep], hashes[keep]
            of = (hashes % np.uint64(buckets)).astype(np.int64)
            document = np.searchsorted(borders, anchor, side="right") - 1
            id, position = ids[document], anchor - borders[document]
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                here = order[cuts[b] : cuts[b + 1]]
                right_size, left_size = last[here] + length - anchor[here], anchor[here] - first[here]
                right = suffixes.strings(data, anchor[here], right_size, length)
                left = suffixes.strings(data, anchor[here] - 1, left_size, length - k, -1)
                by = suffixes.sort_order(right, right_size, left, left_size, id[here], position[here])
                here, right, left, right_size, left_size = here[by], right[by], left[by], right_size[by], left_size[by]
                same = _later_copies(right, left, right_size, left_size, id[here], position[here])
                again = here[same]
                rows += _intervals(np.full(len(again), name), first[again], last[again] + length)
                own = here[~same]
                rows.append(
                    (name, int(b), _pack_run(right[~same], left[~same], right_size[~same], left_size[~same], id[own], position[own], anchor[own], np.full(len(own), name)))
                )
        scan.release()
        return pa.Table.from_batches([_rows(rows, ("block", "bucket", "payload"))])

    return run


def _merged(payloads: list[bytes], length: int, k: int) -> tuple[dict[str, np.ndarray], np.ndarray, list[tuple]]:
    """One run out of several, its common prefixes, and what its equal strings cover."""
    runs = [_unpack_run(p, length, k) for p in payloads]
    order, prefix = suffixes.merge([r["right"] for r in runs], [r["shared"] for r in runs])
    whole = {name: np.concatenate([r[name] for r in runs])[order] for name in runs[0] if name != "shared"}
    # Equal right strings stand together; order them by the rest, so that equal rows do too.
    # A string that ends is put before those that go on with zero bytes.
    group = np.cumsum(prefix < length)
    by = suffixes.sort_order(group, whole["right_size"], whole["left"], whole["left_size"], whole["id"], whole["position"])
    whole = {name: values[by] for name, values in whole.items()}
    same = _later_copies(*(whole[name] for name in ("right", "left", "right_size", "left_size", "id", "position")))
    start = whole["place"][same] - whole["left_size"][same]
    rows = _intervals(whole["block"][same], start, whole["place"][same] + whole["right_size"][same])
    return {name: values[~same] for name, values in whole.items()}, prefix[~same], rows


def _merge_level(length: int, k: int):
    """Merge the runs of one bucket and part into one run."""

    def run(table: pa.Table) -> pa.Table:
        whole, _, rows = _merged(table.column("payload").to_pylist(), length, k)
        fields = ("right", "left", "right_size", "left_size", "id", "position", "place", "block")
        rows.append((table.column("part")[0].as_py(), table.column("bucket")[0].as_py(), _pack_run(*(whole[f] for f in fields))))
        return pa.Table.from_batches([_rows(rows, ("block", "bucket", "payload"))])

    return run


def _merge_last(length: int, k: int):
    """Merge a bucket's last runs, and tell what of each anchor's windows occurred before."""

    def run(table: pa.Table) -> pa.Table:
        whole, prefix, rows = _merged(table.column("payload").to_pylist(), length, k)
        rank = np.empty(len(prefix), dtype=np.int64)
        rank[np.lexsort((whole["position"], whole["id"]))] = np.arange(len(prefix))
        # Rows that repeat an id and text are one document: the same place has the same rank.
        by = np.argsort(rank)
        tie = np.zeros(len(by), dtype=np.int64)
        if len(by):
            tie[1:] = (np.diff(whole["id"][by]) != 0) | (np.diff(whole["position"][by]) != 0)
        rank[by] = np.cumsum(tie)
        low, high = suffixes.covered(whole["right"], whole["left"], whole["right_size"], whole["left_size"], prefix, rank, length)
        hit = high >= 0
        start, end = whole["place"][hit] - high[hit], whole["place"][hit] - low[hit] + length
        rows += _intervals(whole["block"][hit], start, end)
        return pa.Table.from_batches([_rows(rows, ("block", "bucket", "payload"))])

    return run


RESULT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _cut(block: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of a block without the covered bytes."""
    ids, data, borders = _text(block)
    change = np.zeros(len(data) + 1, dtype=np.int32)
    for payload in found.column("payload").to_pylist():
        start, end = scan.unpress_arrays(payload)
        np.add.at(change, start, 1)
        np.add.at(change, end, -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = data[~gone]
    cuts = np.concatenate([[0], np.cumsum(~gone)])[borders]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[borders] = True
    begin = gone.copy()
    begin[1:] &= ~gone[:-1] | edge[1:-1]
    finish = gone.copy()
    finish[:-1] &= ~gone[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    document = np.searchsorted(borders, start, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(start - borders[document]), pa.array(end - borders[document])], names=["start", "end"])
    offsets = np.searchsorted(document, np.arange(len(ids) + 1)).astype(np.int32)
    doc_ids = pa.array(ids, mask=ids == -(1 << 63))
    return pa.table(
        {
            "doc_id": doc_ids,
            "n_bytes": pa.array(np.diff(borders)),
            "spans": pa.ListArray.from_arrays(pa.array(offsets), spans),
            "kept": scan.binary_column(kept, cuts),
        }
    )


def dedup(
    docs: DataFrame, text: str = "text", id: str = "doc_id", length: int = LENGTH, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES, fan: int = FAN
) -> DataFrame:
    """``doc_id``, ``n_bytes``, removed ``spans`` and ``kept`` bytes of every row of ``docs``.

    The number of buckets follows the bytes of all texts.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-int(total) // block_bytes))
    blocks = bucketed(rows.mapInArrow(_blocks(buckets, length, anchor, block_bytes), BLOCKS), "block", buckets, "suffix_blocks")
    texts = blocks.where("bucket = -1")
    hashes = blocks.where("bucket >= 0").select("block", "bucket", "payload")
    masks = hashes.groupBy("bucket").applyInArrow(_repeated, RUNS)
    found = texts.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(_runs(buckets, length, anchor), RUNS)
    found = materialize(found, "suffix-runs")
    covers = found.where("bucket = -1")
    runs = found.where("bucket >= 0")
    most = runs.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    while most > fan:
        part = F.pmod(F.xxhash64("block"), F.lit(-(-most // fan))).alias("part")
        level = runs.select(part, "bucket", "payload").groupBy("part", "bucket").applyInArrow(_merge_level(length, anchor), RUNS)
        level = materialize(level, "suffix-runs")
        covers = covers.unionByName(level.where("bucket = -1"))
        runs = level.where("bucket >= 0")
        most = runs.groupBy("bucket").count().agg(F.max("count")).first()[0]
    last = runs.groupBy("bucket").applyInArrow(_merge_last(length, anchor), RUNS)
    covers = covers.unionByName(last).select("block", "payload")
    return texts.groupBy("block").cogroup(covers.groupBy("block")).applyInArrow(_cut, RESULT)
