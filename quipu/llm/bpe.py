"""Byte-level BPE over whole texts by one shuffle of distinct words, and its decoding.

A task splits the texts of a block (some megabytes of whole documents) into pre-tokens,
keeps for every document the positions as numbers of the block's distinct words, and
sends each distinct word of the block once, packed by hash bucket.  A bucket meets all
blocks' copies of a word, encodes each distinct word once, and sends the ids back to the
blocks, where they are put together by position.  So a word that fills a third of all
text crosses the shuffle once per block.  A block cuts its words into at most ``FAN``
packets; beyond as many blocks the exchange goes by groups of about ``FAN`` blocks, each of which
encodes a distinct word once, so that packets grow with the blocks and no bucket grows.

The added tokens of a tokenizer file are cut out of the texts first, as its library does by
default, and each occurrence is a word of its own.

Nulls and empty texts have no tokens.  A null id stays null.  Repeated rows and repeated ids each get their own
result.  Columns beside the id and the text are not read.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.llm import scan
from quipu.llm.tables import bucketed

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
WORDS_AT_ONCE = 512
FAN = 1_024

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@cache
def _classes() -> np.ndarray:
    """For each code point: white space, letter, number or other."""
    import regex

    table = np.full(0x110000, OTHER, dtype=np.uint8)
    kinds = [(SPACE, regex.compile(r"\p{White_Space}+")), (LETTER, regex.compile(r"\p{L}+")), (NUMBER, regex.compile(r"\p{N}+"))]
    for base in range(0, 0x110000, 0x800):
        if 0xD800 <= base < 0xE000:
            continue
        text = "".join(map(chr, range(base, base + 0x800)))
        for kind, pattern in kinds:
            for found in pattern.finditer(text):
                table[base + found.start() : base + found.end()] = kind
    return table


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of a UTF-8 text belongs to."""
    table = _classes()
    classes = table[:128][np.minimum(data, 127)]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)]).astype(np.uint32)
        head, one, two, three = (padded[lead + k] for k in range(4))
        one, two, three = one & 63, two & 63, three & 63
        size = 2 + (head >= 0xE0) + (head >= 0xF0)
        point = np.where(
            size == 2,
            (head & 31) << 6 | one,
            np.where(size == 3, (head & 15) << 12 | one << 6 | two, (head & 7) << 18 | one << 12 | two << 6 | three),
        )
        kind = table[point]
        for k in range(4):
            has = size > k
            classes[lead[has] + k] = kind[has]
    return classes


def pretoken_starts(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Where the matches of the public byte-level BPE pattern begin, in valid UTF-8 texts.

    The pattern takes a contraction ('s 't 're 've 'm 'll 'd), a run of letters, of
    numbers or of other signs with at most one blank before it, and runs of white space
    without the last character before anything else.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    kind = _byte_classes(data)
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[borders] = True
    run = np.ones(n + 1, dtype=bool)
    run[1:-1] = kind[1:] != kind[:-1]
    run |= text_start
    starts = np.flatnonzero(run)
    begin = run.copy()
    # White space before something else in the same text: its last character stands apart.
    a, b = starts[:-1], starts[1:]
    before = (kind[a] == SPACE) & ~text_start[b]
    after = b[before]
    blank = data[after - 1] == 0x20
    begin[after[blank]] = False
    begin[after[blank] - 1] = True
    last = after[~blank] - 1
    while len(wide := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[wide] -= 1
    begin[last] = True
    # A lone apostrophe with no blank before it, and a contraction's letters after it.
    lone = a[(b - a == 1) & (data[a] == 0x27)]
    lone = lone[begin[lone] & (lone + 1 < n)]
    lone = lone[(kind[lone + 1] == LETTER) & ~text_start[lone + 1]]
    first = data[lone + 1]
    second = np.where((lone + 2 < n) & ~text_start[np.minimum(lone + 2, n)], data[np.minimum(lone + 2, n - 1)], 0)
    size = np.where(np.isin(first, np.frombuffer(b"stmd", dtype=np.uint8)), 1, 0)
    for pair in (b"re", b"ve", b"ll"):
        size[(first == pair[0]) & (second == pair[1])] = 2
    lone, size = lone[size > 0], size[size > 0]
    begin[lone + 1] = False
    rest = lone + 1 + size
    inner = (rest < n) & ~run[rest]
    begin[rest[inner]] = True
    return np.flatnonzero(begin[:n])


def word_starts(data: np.ndarray, borders: np.ndarray, added: re.Pattern[bytes] | None) -> np.ndarray:
    """Where pre-tokens begin, each added token in a text being one word between two texts."""
    whole = data.tobytes() if added else b""
    if added is None or not added.search(whole):
        return pretoken_starts(data, borders)
    cuts = zip(borders[:-1].tolist(), borders[1:].tolist())
    spans = np.array([m.span() for a, b in cuts for m in added.finditer(whole, a, b)], dtype=np.int64).reshape(-1, 2)
    begin = pretoken_starts(data, np.unique(np.concatenate([borders, spans.ravel()])))
    span = np.searchsorted(spans[:, 0], begin, side="left") - 1
    inside = (span >= 0) & (begin < np.append(spans[:, 1], 0)[span])
    return begin[~inside]


@dataclass(frozen=True)
class RankFile:
    """Encoder of distinct words by a rank file (``base64 rank`` lines) and a pattern."""

    path: str
    pattern: str

    def encoder(self):
        return _rank_encoder(self.path, self.pattern)

    def added(self) -> None:
        return None

    def token_bytes(self) -> list[bytes]:
        ranks = _ranks(self.path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        return table


@dataclass(frozen=True)
class TokenizerFile:
    """Encoder of distinct words by a file of the tokenizers library."""

    path: str

    def encoder(self):
        return _file_encoder(self.path)

    def added(self) -> re.Pattern[bytes] | None:
        """A pattern of the added tokens, the longest first."""
        return _added_tokens(self.path)


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _rank_encoder(path: str, pattern: str):
    import tiktoken

    coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
    return lambda words: [coder.encode_ordinary(w) for w in words]


@cache
def _added_tokens(path: str) -> re.Pattern[bytes] | None:
    with open(path, encoding="utf-8") as content:
        tokens = json.load(content).get("added_tokens") or []
    for token in tokens:
        if token.get("single_word") or token.get("lstrip") or token.get("rstrip"):
            raise ValueError(f"added token {token['content']!r} depends on what stands around it")
    spelled = sorted({t["content"].encode() for t in tokens}, key=lambda t: (-len(t), t))
    return re.compile(b"|".join(map(re.escape, spelled))) if spelled else None


@cache
def _file_encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)

    return lambda words: [e.ids for e in coder.encode_batch_fast(words, add_special_tokens=False)]


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), dtype="<u4", count=len(words))
    return scan.press(np.uint32(len(words)).tobytes() + sizes.tobytes() + b"".join(words), level=6)


def _unpack_words(packed: bytes) -> list[bytes]:
    data = scan.unpress(packed).tobytes()
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, dtype="<u4", count=n, offset=4), dtype=np.int64) + 4 + 4 * n
    out, at = [], 4 + 4 * n
    for end in ends.tolist():
        out.append(data[at:end])
        at = end
    return out


BLOCK_SCHEMA = "block long, bucket int, doc_ids binary, sizes binary, counts binary, payload binary"


def _block_rows(block: int, held: list[tuple[np.ndarray, ...]], buckets: int, groups: int) -> pa.RecordBatch:
    """One row with the documents of a block as word numbers, and one for each bucket of its words."""
    ids, named, data, borders, begin, hashes = (list(part) for part in zip(*held))
    text = b"".join(d.tobytes() for d in data)
    shift = np.cumsum([0, *map(len, data)])
    begin = np.concatenate([b + s.astype(b.dtype) for b, s in zip(begin, shift)])
    borders = np.concatenate([[0], *(b[1:] + s for b, s in zip(borders, shift))])
    hashes = np.concatenate(hashes)
    end = np.append(begin[1:], len(text))
    order = np.argsort(hashes)
    ranked = hashes[order]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(hashes), dtype=np.int32)
    number[order] = np.cumsum(fresh, dtype=np.int32) - 1
    at = np.flatnonzero(fresh)
    first, count = order[at], np.diff(np.append(at, len(ranked)))
    del order, ranked, fresh, at
    spelled = [text[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
    bucket = (hashes[first] % np.uint64(buckets)).astype(np.int64)
    # Like words side by side compress best; any fixed order would do.
    by_bucket = np.lexsort((np.array(spelled, dtype="S8"), bucket)) if spelled else np.zeros(0, dtype=np.int64)
    count = count[by_bucket]
    # Positions hold ranks by frequency in the block; counts let the reader restore the order.
    rank = np.empty(len(count), dtype=np.int32)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
    place = np.empty(len(count), dtype=np.int32)
    place[by_bucket] = rank
    sizes = np.diff(np.searchsorted(begin, borders))
    cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    doc_ids = np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(named).tobytes()
    before = int(scan.mix(np.array([block], dtype=np.uint64))[0]) % groups * buckets  # buckets of the groups before the block's
    rows = [(block, -1, doc_ids, scan.press_numbers(sizes), scan.press_numbers(count), scan.press_numbers(place[number]))]
    for k in np.flatnonzero(np.diff(cuts)):
        here = slice(cuts[k], cuts[k + 1])
        rows.append((block, before + int(k), None, None, scan.press_numbers(count[here]), _pack_words([spelled[i] for i in by_bucket[here]])))
    types = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
    names = ("block", "bucket", "doc_ids", "sizes", "counts", "payload")
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)


def _split_blocks(words_of: RankFile | TokenizerFile, buckets: int, groups: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        added = words_of.added()
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ids, named = scan.numbers(batch.column(0))
            for a, b, data, borders in scan.slices(batch.column(1)):
                if held and size + len(data) > limit:
                    yield _block_rows(block, held, buckets, groups)
                    held, size, block = [], 0, block + 1
                    scan.release()
                begin = word_starts(data, borders, added)
                hashes = scan.span_hashes(data, begin, np.append(begin[1:], len(data)))
                held.append((ids[a:b], named[a:b], data.copy(), borders, begin if len(data) >= 1 << 30 else begin.astype(np.int32), hashes))
                size += len(data)
        if held:
            yield _block_rows(block, held, buckets, groups)
        held.clear()
        scan.release()

    return run


def _encode_words(encode, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each word has, and all ids; a few words at a time, as lists of ids take much room."""
    sizes, flat = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype="<u4")]
    for a in range(0, len(words), WORDS_AT_ONCE):
        ids = encode([w.decode("utf-8") for w in words[a : a + WORDS_AT_ONCE]])
        sizes.append(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
        flat.append(np.fromiter((i for word in ids for i in word), dtype="<u4", count=int(sizes[-1].sum())))
    return np.concatenate(sizes), np.concatenate(flat)


def _encode_bucket(words_of: RankFile | TokenizerFile, numbers: bool):
    def run(table: pa.Table) -> pa.Table:
        encode = words_of.encoder()
        known: dict[bytes, int] = {}
        payloads = table.column("payload").to_pylist()
        places = []
        for packed in payloads:
            places.append(np.array([known.setdefault(w, len(known)) for w in _unpack_words(packed)], dtype=np.int64))
        sizes, flat = _encode_words(encode, list(known))
        known.clear()
        starts = np.cumsum(sizes) - sizes
        out = []
        total = np.zeros(len(sizes), dtype=np.int64)
        for place, counts in zip(places, table.column("counts").to_pylist()):
            total[place] += scan.unpress_numbers(counts)
            size = sizes[place]
            out.append([scan.press_numbers(np.concatenate([[len(place)], size, flat[scan.ragged(starts[place], size)]])), None, None])
        if numbers:
            used = np.bincount(flat, weights=np.repeat(total, sizes))
            token = np.flatnonzero(used)
            out[0][1:] = scan.press_numbers(token), scan.press(used[token].astype("<i8"))
        payload, token, total = zip(*out)
        scan.release()
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "payload": pa.array(payload, type=pa.binary()),
                "tokens": pa.array(token, type=pa.binary()),
                "totals": pa.array(total, type=pa.binary()),
            }
        )

    return run


def _join_block(documents: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of a block's documents, put together by position."""
    doc_ids, sizes, counts, payload = (documents.column(c)[0].as_py() for c in ("doc_ids", "sizes", "counts", "payload"))
    n_ids = len(doc_ids) // 9  # eight bytes each, and one that tells whether it is there
    ids, named = np.frombuffer(doc_ids, dtype="<i8", count=n_ids), np.frombuffer(doc_ids, dtype=bool, offset=8 * n_ids)
    word_sizes, word_ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    if words.num_rows:
        for packed in words.sort_by("bucket").column("payload").to_pylist():
            numbers = scan.unpress_numbers(packed).astype(np.int64)
            n = int(numbers[0])
            word_sizes.append(numbers[1 : n + 1])
            word_ids.append(numbers[n + 1 :])
    size, flat = np.concatenate(word_sizes), np.concatenate(word_ids)
    start = np.cumsum(size) - size
    by_rank = np.argsort(-scan.unpress_numbers(counts).astype(np.int64), kind="stable")
    places = by_rank[scan.unpress_numbers(payload)].astype(np.int32)
    tokens = np.concatenate([[0], np.cumsum(scan.unpress_numbers(sizes), dtype=np.int64)])
    ends = np.concatenate([[0], np.cumsum(size[places])])
    borders = ends[tokens]
    out = np.empty(int(ends[-1]), dtype="<u4")
    for a in range(0, len(places), 1 << 18):
        of = places[a : a + (1 << 18)]
        out[ends[a] : ends[a + len(of)]] = flat[scan.ragged(start[of], size[of])]
    del places, ends, by_rank
    scan.release()
    return pa.table(
        {
            "doc_id": pa.array(ids, type=pa.int64(), mask=~named),
            "n_tokens": pa.array(np.diff(borders), type=pa.int64()),
            "ids": scan.binary_column(out, borders * 4),
        }
    )


DOCUMENTS = "doc_id long, n_tokens long, ids binary"


@dataclass(frozen=True)
class Words:
    """Documents as blocks of word numbers, and the ids of each block's words."""

    blocks: DataFrame
    encoded: DataFrame

    def documents(self, then: Callable[[pa.Table], pa.Table] | None = None, schema: str = DOCUMENTS) -> DataFrame:
        """One row per document: ``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit).

        ``then`` turns these rows of a block into others while they are at hand in a task.
        """

        def join(documents: pa.Table, words: pa.Table) -> pa.Table:
            found = _join_block(documents, words)
            return then(found) if then else found

        return (
            self.blocks.where("bucket = -1")
            .groupBy("block")
            .cogroup(self.encoded.select("block", "bucket", "payload").groupBy("block"))
            .applyInArrow(join, schema)
        )


def encode_words(
    docs: DataFrame, words_of: RankFile | TokenizerFile, text: str = "text", id: str = "doc_id",
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, count_tokens: bool = False, fan: int = FAN,
) -> Words:
    """Split the texts, and encode each distinct word of a group of blocks once.

    The number of buckets, and beyond ``fan`` that of groups, follows the bytes of all texts,
    so that what one task gathers stays the same at any size.  Invalid UTF-8 is replaced as
    Spark does.
    """
    clean = F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), clean.alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    files = max(1, -(-int(total) // block_bytes))
    groups = -(-buckets // fan)
    packets = -(-buckets // groups)
    blocks = bucketed(rows.mapInArrow(_split_blocks(words_of, packets, groups, block_bytes), BLOCK_SCHEMA), "block", files, "bpe_blocks")
    encoded = (
        blocks.where("bucket >= 0")
        .select("block", "bucket", "counts", "payload")
        .groupBy("bucket")
        .applyInArrow(_encode_bucket(words_of, count_tokens), "block long, bucket int, payload binary, tokens binary, totals binary")
    )
    return Words(blocks, encoded)


def encode(docs: DataFrame, words_of: RankFile | TokenizerFile, text: str = "text", id: str = "doc_id", **limits: int) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (binary) of every row of ``docs``."""
    return encode_words(docs, words_of, text, id, **limits).documents()


def decode(encoded: DataFrame, words_of: RankFile, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that each document's ids stand for.

    The token-byte table is as large as the tokenizer's vocabulary, whatever the input;
    every task joins its ids with it by look-up.  A null stays null.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, start, size = _token_table(words_of)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            parts = []
            for a, b, data, borders in scan.slices(column, limit=1 << 21):
                token = np.frombuffer(data.tobytes(), dtype="<u4")
                ends = np.concatenate([[0], np.cumsum(size[token])])
                parts.append(scan.binary_column(flat[scan.ragged(start[token], size[token])], ends[borders // 4]))
            found = pa.concat_arrays(parts) if parts else pa.array([], type=pa.binary())
            if column.null_count:
                found = pc.if_else(column.is_valid(), found, None)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])
            del batch, column, parts, found
            scan.release()

    return encoded.mapInArrow(run, schema)


@cache
def _token_table(words_of: RankFile) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tokens = words_of.token_bytes()
    size = np.array([len(t) for t in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(size) - size, size
