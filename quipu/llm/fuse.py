"""Static binary-fuse filters: nine bits a key, no false negatives, one false positive in 256."""

from __future__ import annotations

import math
import struct

import numpy as np

from quipu.llm import scan

_HEAD = struct.Struct("<QIII")


class FuseFilter:
    """Built once from distinct 64-bit keys, then only read.

    Each key owns three cells in three neighbouring segments; the exclusive or of the
    cells is the key's fingerprint.
    """

    def __init__(self, seed: int, segment: int, span: int, cells: np.ndarray):
        self.seed, self.segment, self.span, self.cells = seed, segment, span, cells

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Of any keys; repeated ones count once, none gives a filter that holds nothing."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        if n == 0:
            return cls(0, 0, 0, np.zeros(0, dtype=np.uint8))
        segment = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        span = segments * segment
        for seed in range(1, 200):
            found = cls(seed, segment, span, np.zeros(span + 2 * segment, dtype=np.uint8))
            if found._fill(keys):
                return found
            if seed % 20 == 0:
                span += segment
        raise RuntimeError("no seed gives a filter of these keys")

    def _cells_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = scan.mix(keys + scan.mix(np.array([self.seed], dtype=np.uint64)))
        first = ((h >> np.uint64(32)) * np.uint64(self.span)) >> np.uint64(32)
        inner = np.uint64(self.segment - 1)
        second = (first + np.uint64(self.segment)) ^ ((h >> np.uint64(13)) & inner)
        third = (first + np.uint64(2 * self.segment)) ^ (h & inner)
        prints = scan.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).astype(np.uint8)
        return np.stack([first, second, third]).astype(np.int64), prints

    def _fill(self, keys: np.ndarray) -> bool:
        places, prints = self._cells_of(keys)
        size = len(self.cells)
        flat = places.ravel()
        count = np.bincount(flat, minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        np.add.at(owner, flat, np.tile(np.arange(len(keys)), 3))
        rounds: list[tuple[np.ndarray, np.ndarray]] = []
        alone, left = np.flatnonzero(count == 1), len(keys)
        while len(alone):
            key, at = np.unique(owner[alone], return_index=True)
            rounds.append((key, alone[at]))
            left -= len(key)
            touched = places[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(owner, touched, np.tile(key, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            return False
        for key, cell in reversed(rounds):
            a, b, c = places[:, key]
            self.cells[cell] = 0
            self.cells[cell] = prints[key] ^ self.cells[a] ^ self.cells[b] ^ self.cells[c]
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.cells) or not len(keys):
            return np.zeros(len(keys), dtype=bool)
        (a, b, c), prints = self._cells_of(keys.astype(np.uint64))
        return (self.cells[a] ^ self.cells[b] ^ self.cells[c]) == prints

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.seed, self.segment, self.span, len(self.cells)) + self.cells.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> FuseFilter:
        seed, segment, span, _ = _HEAD.unpack_from(data)
        return cls(seed, segment, span, np.frombuffer(data, dtype=np.uint8, offset=_HEAD.size))
