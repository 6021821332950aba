"""Sorted runs of anchored strings: front coding, and a merge that never compares known prefixes again.

Helpers of ``suffix_dedup`` that work on the rows of one task.
"""

from __future__ import annotations

import numpy as np

from quipu.llm import scan

_POSITION_BITS = 22
_PIECE = 1 << 21


def anchors(data: np.ndarray, borders: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window, and hash of the anchor's ``k`` bytes.

    The anchor of a window of ``length`` bytes is where the least hashed ``k`` bytes in it
    begin, the first of several; it depends on the window's bytes alone.  Windows of one
    anchor follow each other and are told by the first and last start.
    """
    found = []
    reach = length - k + 1
    keep = np.uint64((1 << _POSITION_BITS) - 1)
    for low in range(0, max(len(data) - length + 1, 0), _PIECE):
        part = data[low : low + _PIECE + length - 1]
        sums = scan.prefix_sums(part)
        at = np.arange(len(part) - k + 1)
        codes = scan.range_hash(sums, at, at + k)
        least = (codes & ~keep) | at.astype(np.uint64)
        size = 1
        while size * 2 <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if reach > size:
            least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
        place = (least & keep).astype(np.int64)
        # Windows across the border of two texts do not count.
        whole = np.zeros(len(place) + 1, dtype=np.int64)
        first = np.clip(borders[:-1] - low, 0, len(place))
        last = np.clip(borders[1:] - length + 1 - low, 0, len(place))
        some = last > first
        np.add.at(whole, first[some], 1)
        np.add.at(whole, last[some], -1)
        starts = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
        if not len(starts):
            continue
        place = place[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(starts)) - 1
        found.append((place[begin] + low, starts[begin] + low, starts[end] + low, codes[place[begin]]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """One row of ``width`` bytes for each string, zero beyond its size; backwards if ``step`` is -1."""
    reach = np.arange(width)
    at = start[:, None] + step * reach
    inside = reach < size[:, None]
    out = data[np.where(inside, at, 0)] if len(data) else np.zeros((len(start), width), dtype=np.uint8)
    out[~inside] = 0
    return out


def sort_order(*keys: np.ndarray) -> np.ndarray:
    """Order by byte matrices and numbers, the first key first."""
    columns: list[np.ndarray] = []
    for key in keys:
        if key.ndim == 1:
            columns.append(key)
            continue
        padded = np.zeros((len(key), -(-key.shape[1] // 8) * 8), dtype=np.uint8)
        padded[:, : key.shape[1]] = key
        wide = padded.view(">u8")
        columns += [wide[:, c].astype(np.uint64) for c in range(wide.shape[1])]
    return np.lexsort(columns[::-1])


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many first bytes each row shares with the row before; 0 for the first."""
    out = np.zeros(len(rows), dtype=np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def front_code(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of each row with the one before, and the bytes beyond it up to the row's size."""
    shared = common_prefixes(rows)
    reach = np.arange(rows.shape[1])
    return shared.astype(np.uint8), rows[(reach >= shared[:, None]) & (reach < size[:, None])]


def front_decode(shared: np.ndarray, rest: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The rows back: each byte comes from the last row that spelled it out."""
    out = np.zeros((len(size), width), dtype=np.uint8)
    reach = np.arange(width)
    own = (reach >= shared[:, None]) & (reach < size[:, None])
    out[own] = rest
    rows = np.arange(len(size))
    for c in range(width):
        last = np.maximum.accumulate(np.where(shared <= c, rows, 0))
        out[:, c] = np.where(c < size, out[last, c], 0)
    return out


def merge(runs: list[np.ndarray], shared: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs of equally wide rows by a loser tree over common prefixes.

    ``shared`` holds each row's common prefix with the row before in its run.  Of two
    candidates the one that shares more with the row last put out is smaller; only if both
    share equally much are bytes compared, and only those beyond.  Returns the order in
    the concatenated runs, and each row's common prefix with the one before in that order.
    """
    total = sum(map(len, runs))
    width = runs[0].shape[1] if runs else 0
    order = np.zeros(total, dtype=np.int64)
    prefix = np.zeros(total, dtype=np.int64)
    if not total:
        return order, prefix
    numbers = []
    for run in runs:
        flat = np.ascontiguousarray(run).tobytes()
        numbers.append([int.from_bytes(flat[i : i + width], "big") for i in range(0, len(flat), width)])
    own = [s.tolist() for s in shared]
    base = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).tolist()
    count = 1 << max(0, (len(runs) - 1).bit_length())
    ended = -1  # the shared prefix of a run without further rows: it loses against all
    head = [0] * count
    lcp = [0 if r < len(runs) and numbers[r] else ended for r in range(count)]
    loser = [0] * count

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        if lcp[x] > lcp[y]:
            return x, y
        if lcp[y] > lcp[x]:
            return y, x
        if lcp[x] == ended:
            return (x, y) if x < y else (y, x)
        a, b = numbers[x][head[x]], numbers[y][head[y]]
        if a < b or (a == b and x < y):
            winner, beaten = x, y
        else:
            winner, beaten = y, x
        lcp[beaten] = width - ((a ^ b).bit_length() + 7) // 8
        return winner, beaten

    winners = list(range(count))
    level = count
    while level > 1:
        level //= 2
        for i in range(level):
            winners[i], loser[level + i] = play(winners[2 * i], winners[2 * i + 1])
    best = winners[0]
    for at in range(total):
        order[at] = base[best] + head[best]
        prefix[at] = lcp[best]
        head[best] += 1
        lcp[best] = own[best][head[best]] if head[best] < len(own[best]) else ended
        node = (count + best) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2
    prefix[0] = 0
    return order, prefix


def covered(
    right: np.ndarray, left: np.ndarray, right_size: np.ndarray, left_size: np.ndarray, prefix: np.ndarray, rank: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least and the largest offset of a window that a row of smaller rank has too.

    Rows are in the order of their right strings, and ``prefix`` are the common prefixes
    there.  A window at offset ``o`` is the first ``o`` bytes to the left of the anchor
    and the first ``length - o`` from it on.  Rows without such a window get
    ``(length, -1)``.
    """
    n = len(rank)
    low, high = np.full(n, length, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    if n < 2:
        return low, high
    by_left = sort_order(left)
    left_prefix = common_prefixes(left[by_left])
    by_rank = np.argsort(rank, kind="stable")
    left_group = np.empty(n, dtype=np.int64)
    for o in range(int(left_size.max()) + 1):
        rows = by_rank[(left_size[by_rank] >= o) & (right_size[by_rank] >= length - o)]
        if len(rows) < 2:
            continue
        right_group = np.cumsum(prefix < length - o)
        left_group[by_left] = np.cumsum(left_prefix < o) if o else 0
        key = right_group[rows] * (n + 1) + left_group[rows]
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        at = np.arange(len(rows))
        first = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
        hit = rows[rank[rows] > rank[rows[first]]]
        low[hit] = np.minimum(low[hit], o)
        high[hit] = o
    return low, high
