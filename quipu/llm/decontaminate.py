"""Passages of test items in training documents, edited ones too.

Words are lower-cased runs of ASCII letters and digits and of anything beyond ASCII.  The
pairs of words of an item that stand next to each other, or with one word between, are
counted over all documents; those that are not far more frequent than the item's median
pair are its seeds, however often the item itself was copied.  In documents pairs are read
with and without a word between too, so that inserted, dropped and replaced words leave
seeds in place.  Where a stretch of a document, about as long as an item, holds enough of
the item's seeds, local alignment (Smith-Waterman, words as letters) scores the stretch by
the share of the item's own score.

The alignment alone would accept some pairs that leave no three seeds: two or more words
put in between most words of an item, or long items kept only in single scattered words.
A test measures the recall against the full alignment of all pairs.

Test items are sent to all tasks in blocks of a fixed number of bytes, so a benchmark of
any size works with bounded memory; documents are read once per block and pass.  Null and
empty texts and items have no words and match nothing.  Items of one word have it as the
only seed.  Very long texts are read whole, a slice of their own.  Repeated rows of a document or an item give
the pair once, with its best score.  Columns beside ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import scan

LEAST_SEEDS = 3
LEAST_SCORE = 0.5
FREQUENT, FEW = 4, 8
MATCH, MISMATCH, GAP = 2, 1, 1
BLOCK_BYTES = 16 << 20
CELLS = 1 << 18
SIFT_BITS = 20


@dataclass(frozen=True)
class Items:
    """The words of a block of test items, and their n-grams in ascending order of hash."""

    ids: np.ndarray
    words: np.ndarray
    begins: np.ndarray
    grams: np.ndarray  # distinct hashes, ascending
    first: np.ndarray  # where each hash's places begin
    owner: np.ndarray  # item of each place
    offset: np.ndarray  # word of the item at each place
    need: np.ndarray  # seeds that each item asks for
    sift: np.ndarray

    def length(self) -> np.ndarray:
        return np.diff(self.begins)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are n-grams of items, and their numbers."""
        near = np.flatnonzero(self.sift[(hashes >> np.uint64(64 - SIFT_BITS)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.grams, hashes[near]), max(len(self.grams) - 1, 0))
        same = self.grams[number] == hashes[near] if len(self.grams) else np.zeros(len(near), dtype=bool)
        return near[same], number[same]


def _terms(column: pa.Array, limit: int = scan.SLICE_BYTES):
    for a, b, data, borders in scan.slices(column, limit):
        _, _, hashes, begins = scan.word_hashes(data, borders, inside=scan.IN_TERM)
        yield a, b, hashes, begins


def _apart(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each text's pairs of words with one word between, alike those of neighbours, and where each text's begin."""
    counts = np.maximum(np.diff(begins) - 2, 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    first = scan.ragged(begins[:-1], counts)
    joined = np.stack([hashes[first], hashes[first + 2]], axis=1).ravel()
    codes, _ = scan.ngram_hashes(joined, np.arange(0, 2 * len(first) + 1, 2), 2)
    return codes, starts


def _item_grams(words: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the items' seeds, the item and the first word of each."""
    found = []
    for codes, starts in (scan.ngram_hashes(words, begins, 2, whole_if_short=True), _apart(words, begins)):
        owner = np.repeat(np.arange(len(begins) - 1), np.diff(starts))
        found.append((codes, owner, np.arange(len(codes)) - starts[owner]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _index(ids: np.ndarray, words: np.ndarray, begins: np.ndarray, keep: np.ndarray | None = None, least: int = 1) -> Items:
    grams, owner, offset = _item_grams(words, begins)
    if keep is not None:
        grams, owner, offset = grams[keep], owner[keep], offset[keep]
    order = np.argsort(grams, kind="stable")
    distinct, first = np.unique(grams[order], return_index=True)
    sift = np.zeros(1 << SIFT_BITS, dtype=bool)
    sift[(distinct >> np.uint64(64 - SIFT_BITS)).astype(np.int64)] = True
    seeds = np.bincount(owner, minlength=len(ids))
    need = np.minimum(least, seeds)
    return Items(ids, words, begins, distinct, np.append(first, len(order)), owner[order], offset[order], need, sift)


def _counts(docs: DataFrame, items: Items) -> np.ndarray:
    """In how many documents each n-gram of the items occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.grams), dtype=np.int64)
        for batch in batches:
            for _, _, hashes, begins in _terms(batch.column(1)):
                met = []
                for grams, starts in _all_grams(items, hashes, begins):
                    place, number = items.find(grams)
                    met.append(np.searchsorted(starts, place, side="right") * max(len(items.grams), 1) + number)
                pairs = np.unique(np.concatenate(met)) if met else np.zeros(0, dtype=np.int64)
                total += np.bincount(pairs % max(len(items.grams), 1), minlength=len(total))
            scan.release()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["gram", "n"])

    out = np.zeros(len(items.grams), dtype=np.int64)
    for gram, n in docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[gram] = n
    return out


def _all_grams(items: Items, hashes: np.ndarray, begins: np.ndarray):
    """Pairs of neighbours, pairs with a word between, and single words if an item is one."""
    shortest = items.length()[items.length() > 0].min(initial=2)
    if shortest == 1:
        yield scan.ngram_hashes(hashes, begins, 1)
    if items.length().max(initial=0) > 1:
        yield scan.ngram_hashes(hashes, begins, 2)
        yield _apart(hashes, begins)


def _stretches(items: Items, place: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Item, and word before the stretch's first, of each stretch with enough seeds."""
    size = items.first[number + 1] - items.first[number]
    at = scan.ragged(items.first[number], size)
    owner, word = items.owner[at], np.repeat(place, size)
    start = word - items.offset[at]
    order = np.lexsort((start, owner))
    owner, start, seed = owner[order], start[order], np.repeat(number, size)[order]
    slack = items.length()[owner] // 2 + 1
    # Hits of one item whose stretches nearly begin together belong together.
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] - start[:-1] > slack[1:])
    group = np.cumsum(new) - 1
    seeds = np.unique(group * (len(items.grams) + 1) + seed) // (len(items.grams) + 1)
    enough = np.bincount(seeds, minlength=int(new.sum())) >= items.need[owner[new]]
    low = start[new]
    high = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else start
    return np.stack([owner[new][enough], low[enough], high[enough]], axis=1)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its passage, all at once."""
    if not items:
        return np.zeros(0, dtype=np.int64)
    rows = max(map(len, items))
    columns = max(map(len, passages))
    item = np.zeros((len(items), rows), dtype=np.uint64)
    there = np.zeros((len(items), rows), dtype=bool)
    passage = np.zeros((len(items), columns), dtype=np.uint64)
    inside = np.zeros((len(items), columns), dtype=bool)
    for k, (a, b) in enumerate(zip(items, passages)):
        item[k, : len(a)], there[k, : len(a)] = a, True
        passage[k, : len(b)], inside[k, : len(b)] = b, True
    slope = GAP * np.arange(columns + 1, dtype=np.int32)
    above = np.zeros((len(items), columns + 1), dtype=np.int32)
    best = np.zeros(len(items), dtype=np.int32)
    for i in range(rows):
        same = (passage == item[:, i : i + 1]) & inside & there[:, i : i + 1]
        row = np.zeros_like(above)
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(same, MATCH, -MISMATCH), above[:, 1:] - GAP)
        np.maximum(row, 0, out=row)
        # A gap in the passage costs the same for each word: a running maximum covers all lengths.
        above = np.maximum.accumulate(row + slope, axis=1) - slope
        best = np.maximum(best, above.max(axis=1))
    return best


def _search(items: Items, least_score: float):
    names = ["doc_id", "item_id", "score", "first_word", "last_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, _, hashes, begins in _terms(batch.column(1)):
                found = []
                for grams, starts in _all_grams(items, hashes, begins):
                    place, number = items.find(grams)
                    text = np.searchsorted(starts, place, side="right") - 1
                    found.append((text, begins[text] + place - starts[text], number))
                if not found:
                    continue
                text, word, number = (np.concatenate(part) for part in zip(*found))
                order = np.argsort(text, kind="stable")
                text, word, number = text[order], word[order], number[order]
                cuts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else []
                held: list[tuple] = []
                cells = 0
                for lo, hi in zip(cuts, [*cuts[1:], len(text)]):
                    doc = text[lo]
                    for k, low, high in _stretches(items, word[lo:hi], number[lo:hi]).tolist():
                        own = items.words[items.begins[k] : items.begins[k + 1]]
                        slack = len(own) // 2 + 1
                        first = max(low - slack, int(begins[doc]))
                        last = min(high + len(own) + slack, int(begins[doc + 1]))
                        held.append((ids[a + int(doc)].as_py(), k, own, hashes[first:last], first - int(begins[doc]), last - int(begins[doc])))
                        cells += len(own) + last - first
                        if cells > CELLS:
                            yield from finish(held)
                            held, cells = [], 0
                yield from finish(held)
            scan.release()

    def finish(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda h: len(h[2]) + len(h[3]))
        rows = []
        for lo in range(0, len(held), 256):
            part = held[lo : lo + 256]
            scores = align([h[2] for h in part], [h[3] for h in part])
            for h, s in zip(part, scores.tolist()):
                share = s / (MATCH * len(h[2]))
                if share >= least_score:
                    rows.append((h[0], int(items.ids[h[1]]), share, h[4], h[5]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)

    return run


def pairs(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    least_seeds: int = LEAST_SEEDS, least_score: float = LEAST_SCORE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id``, ``item_id``, best ``score``, and the words of the document that were aligned.

    Documents without an id share one row for each item, with a null id.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    tests = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.lower(item_text).alias("text"))
    tests = tests.where("item_id IS NOT NULL AND text IS NOT NULL").withColumn("size", F.octet_length("text"))
    total = tests.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    found = None
    for k in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else tests
        own = mine.select("item_id", "text").distinct().orderBy("item_id", "text").toArrow()
        ids = own.column("item_id").to_numpy()
        parts = list(_terms(own.column("text"), limit=1 << 40))
        words = parts[0][2] if parts else np.zeros(0, dtype=np.uint64)
        begins = parts[0][3] if parts else np.zeros(1, dtype=np.int64)
        every = _index(ids, words, begins)
        counts = _counts(rows, every)
        items = _index(ids, words, begins, _rare(words, begins, every, counts), least_seeds)
        part = rows.mapInArrow(_search(items, least_score), schema)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("score", -F.col("first_word"), F.col("last_word"))).alias("best")
    joined = found.groupBy("doc_id", "item_id").agg(best)
    return joined.select("doc_id", "item_id", "best.score", (-F.col("best.col2")).alias("first_word"), F.col("best.last_word").alias("last_word"))


def _rare(words: np.ndarray, begins: np.ndarray, every: Items, counts: np.ndarray) -> np.ndarray:
    """Which seeds of each item do not stand out as frequent among the item's own."""
    grams, owner, _ = _item_grams(words, begins)
    if not len(grams):
        return np.zeros(0, dtype=bool)
    seen = counts[np.searchsorted(every.grams, grams)]
    order = np.argsort(owner, kind="stable")
    usual = np.zeros(len(begins) - 1)
    for own in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
        usual[owner[own[0]]] = np.median(seen[own])
    return seen <= FREQUENT * np.maximum(usual, FEW)[owner]


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", **limits) -> DataFrame:
    """The rows of ``docs`` without any test item in them, with all their columns.

    Rows with a null id stay, since no pair can name them.
    """
    dirty = pairs(docs, benchmark, text, id, **limits).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, docs[id].cast("long") == F.col("_dirty"), "left_anti")
