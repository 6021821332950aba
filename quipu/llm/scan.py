"""Whole Arrow text columns as byte arrays: words, their hashes, n-grams, packed numbers.

Everything here is a small helper that runs inside Spark tasks.  Texts are handled in
slices of a few megabytes, so that the arrays beside them stay small; a single longer
text makes a slice of its own.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

SLICE_BYTES = 1 << 21

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_NGRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
LONG_SPAN = 512

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
IN_TERM = np.zeros(256, dtype=bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers: list[np.ndarray] = []

_libc = ctypes.CDLL(ctypes.util.find_library("c")) if sys.platform == "linux" else None
if not hasattr(_libc, "malloc_trim"):
    _libc = None


def release() -> None:
    """Give freed memory back to the machine: a worker lives on, and its executor has a limit."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as int64, 0 for a null, and which of them are there."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), there


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes, and borders of the texts, slice by slice.

    A null counts as an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    borders = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    borders = borders[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(borders, borders[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, flat[borders[row] : borders[end]], borders[row : end + 1] - borders[row]
        row = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers.clear()
        for base in (_BASE, inverse):
            column = np.full(size, base, dtype=np.uint64)
            column[0] = 1
            _powers.append(np.cumprod(column, dtype=np.uint64))
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all of it; one to one."""
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any range follows, see ``range_hash``."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODE[data] * powers(len(data))[0], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between ``start`` and ``end``, alike wherever they stand.

    Strings of a certain structure collide; where that matters, take ``span_hashes``.
    """
    h = (sums[end] - sums[start]) * powers(len(sums))[1][start]
    return mix(h + (end - start).astype(np.uint64) * _NGRAM[63])


def words(data: np.ndarray, borders: np.ndarray, inside: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of given bytes within each text.

    By default these are all but 0x20 and 0x09-0x0D; ``IN_TERM`` takes ASCII letters and
    digits and everything beyond ASCII.
    """
    inside = inside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = borders[:-1][borders[:-1] < borders[1:]]
    first[cuts] = inside[cuts]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the bytes between ``start`` and ``end``, alike wherever they stand.

    Eight bytes at a time go through a mixing step that is one to one and not linear, so
    that no family of strings collides by its structure.  Long spans are digested.
    """
    size = end - start
    out = mix(size.astype(np.uint64) * _NGRAM[62] + np.uint64(seed))
    if not len(size):
        return out
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    live, at = np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        left = size[live] - at
        out[live] = mix(out[live] ^ (eight[start[live] + at] & _LOW_BYTES[np.minimum(left, 8)]))
        at += 8
        live = live[left > 8]
    for k in np.flatnonzero(size > LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def word_hashes(data: np.ndarray, borders: np.ndarray, fold: bool = True, inside: np.ndarray = IN_WORD) -> tuple[np.ndarray, ...]:
    """Starts, ends and hashes of the words, and for each text where its words begin."""
    start, end = words(data, borders, inside)
    return start, end, span_hashes(FOLD[data] if fold else data, start, end), np.searchsorted(start, borders)


def ngram_hashes(hashes: np.ndarray, begins: np.ndarray, n: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word n-grams in order, and where each text's n-grams begin.

    With ``whole_if_short`` a text of fewer words, but at least one, has its whole
    sequence as the only n-gram.
    """
    counts = np.diff(begins)
    grams = np.maximum(counts - n + 1, 0)
    short = (counts > 0) & (counts < n) if whole_if_short else np.zeros(len(counts), dtype=bool)
    sizes = np.where(short, 1, grams)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first = np.repeat(begins[:-1] - starts[:-1], sizes) + np.arange(starts[-1])
    out = np.zeros(len(first), dtype=np.uint64)
    length = np.repeat(np.where(short, counts, n), sizes)
    for k in range(n):
        there = length > k
        if there.all():
            out += hashes[first + k] * _NGRAM[k]
        else:
            out[there] += hashes[first[there] + k] * _NGRAM[k]
    return mix(out + length.astype(np.uint64)), starts


def unique_per_text(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct codes in ascending order, and where each text's begin."""
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.lexsort((codes, text))
    codes, text = codes[order], text[order]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    return codes[keep], np.searchsorted(text[keep], np.arange(len(begins)))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each range, one range after the other."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def press(data: bytes | np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes())


def unpress(data: bytes, dtype: type = np.uint8) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def press_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, low bytes first and then the higher ones, compressed."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return press(planes)


def unpress_numbers(data: bytes) -> np.ndarray:
    planes = unpress(data).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def binary_column(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """An Arrow column of byte strings out of one array and the borders between them."""
    flat = pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), flat]).cast(pa.binary())


def press_arrays(*arrays: np.ndarray) -> bytes:
    """Several one-dimensional arrays in one compressed value."""
    head = b"".join(a.dtype.str.encode().ljust(8) + len(a).to_bytes(8, "little") for a in arrays)
    return press(bytes([len(arrays)]) + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpress_arrays(data: bytes) -> list[np.ndarray]:
    raw = unpress(data).tobytes()
    out, at = [], 1 + 16 * raw[0]
    for k in range(raw[0]):
        kind = np.dtype(raw[1 + 16 * k : 9 + 16 * k].decode().strip())
        n = int.from_bytes(raw[9 + 16 * k : 17 + 16 * k], "little")
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += n * kind.itemsize
    return out
