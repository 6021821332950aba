"""Probability of whole texts by online logistic mixing of hashed-context bit predictors.

A text is its bytes and an end sign.  Every byte is predicted bit by bit by several
predictors, each with its own hashed context: the two bytes before, the three bytes
before, and the current word so far (its last sixteen bytes).  How often each bit followed each context is counted over all texts that the
model may learn from; the table of contexts grows with them, and no task holds all of it.

A predictor's answer is the log odds of a one, 0 for a context never seen.  The answers
are added with weights that a gate selects: those of the bit's place in the byte and, where
the word context is known, an offset to them; after every bit they follow the error.  A table from
quantised answer and place to probability refines the sum, and follows the bits too.  Weights
and table start anew with every text and after every ``SEGMENT`` bytes of it, so that
segments run side by side as lanes of arrays; contexts reach across segments.

How the counts travel: texts are packed into blocks; a block asks once for each of its
distinct (context, byte) keys and each of its distinct words, in packets by key range.
Ranges meet all blocks' packets, add the counts, and answer each packet.  With many
ranges the exchange has levels of at most 2**LEVEL_BITS packets: a range first merges the
packets of a group of blocks, asks the finer ranges once for the group, and spreads the
answers.  So rows grow in proportion to the blocks, and what frequent keys send is added up
on the way.

Beside it stands the base score: words (runs outside 0x20 and 0x09-0x0D, lower-cased in
ASCII) and one end per text, by add-one smoothing over the learnt tokens.

A null text counts as empty, whose probability is that of the end sign.  Invalid UTF-8 is
replaced as Spark does.  A null id stays null; a null ``train`` counts as false.  Repeated
rows and ids count each and get a result each.  A very long text makes a block of its own.
If nothing may be learnt all predictors know nothing.  An empty table gives an empty
result.  Columns beside the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm import scan
from quipu.llm.tables import bucketed
from quipu.session import materialize

BLOCK_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
LEVEL_BITS = 8
GROUP_BLOCKS = 256
SEGMENT = 2048
LANES = 4096
LOG_STEPS = 8
END = 0xFF
ORDERS = (2, 3)
WORD_CONTEXT = 16
#: A context's table has at least 2**SPARE_BITS cells for every byte of text, at most 2**56.
SPARE_BITS = 3

#: An answer is the log odds times ODDS_SCALE in one signed byte; the eight bits' answers make one number.
ODDS_SCALE = 8.0
UNSEEN = 0.4
FIRST_WEIGHT = 0.35
RATE = 0.012
REFINED = 33
REFINE_REACH = 8.0
REFINE_RATE = 0.02
LEAST = 1.0 / 4096

_SEEDS = scan.mix(np.arange(1, 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_HIGH_BYTES = np.array([0] + [((1 << 8 * n) - 1) << 8 * (8 - n) for n in range(1, 9)], dtype=np.uint64)

#: The bits of each byte, the highest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)

_look_up: list[np.ndarray] = []


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed."""
    return scan.press_arrays(*[np.ascontiguousarray(np.asarray(a).astype(np.int64).view(np.uint8).reshape(-1, 8).T).ravel() for a in arrays])


def _unpack(packed: bytes) -> list[np.ndarray]:
    return [np.ascontiguousarray(a.reshape(8, -1).T).view(np.int64).ravel() for a in scan.unpress_arrays(packed)]


def _pack_answer(totals: np.ndarray, bits: np.ndarray) -> bytes:
    """Counts as byte planes, the eight answers of a key side by side."""
    return scan.press_arrays(np.ascontiguousarray(totals.view(np.uint8).reshape(-1, 8).T).ravel(), bits.view(np.uint8))


def _unpack_answer(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    totals, bits = scan.unpress_arrays(packed)
    return np.ascontiguousarray(totals.reshape(8, -1).T).view(np.int64).ravel(), bits.copy().view(np.int64)


def _rise(keys: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned keys, as numbers that ``_fall`` adds up again."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.int64)


def _fall(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.view(np.uint64), dtype=np.uint64)


# Blocks


def _pack_blocks(limit: int):
    names = ["block", "n_bytes", "trained", "packed"]

    def row(block: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        named, ids, train, sizes, data = (np.concatenate(part) for part in zip(*held))
        packed = scan.press_arrays(named.astype("u1"), ids, train.astype("u1"), sizes.astype("<i8"), data)
        values = [[block], [len(data)], [int(train.sum())], [packed]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ids, named = scan.numbers(batch.column(0))
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, data, borders in scan.slices(batch.column(2)):
                if held and size + len(data) > limit:
                    yield row(block, held)
                    held, size, block = [], 0, block + 1
                held.append((named[a:b], ids[a:b], train[a:b], np.diff(borders), data.copy()))
                size += len(data)
        if held:
            yield row(block, held)
        scan.release()

    return run


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct value, in ascending order of the values, and which of them each value is."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Block:
    """The texts of a block, each followed by the end sign, with all that is asked for them."""

    def __init__(self, packed: bytes, context_bits: int):
        self.context_bits = context_bits
        named, self.ids, train, sizes, text = scan.unpress_arrays(packed)
        self.named, self.train = named.astype(bool), train.astype(bool)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.data = np.empty(len(text) + len(sizes), dtype=np.uint8)
        at_end = np.zeros(len(self.data), dtype=bool)
        at_end[self.ends] = True
        self.data[at_end] = END
        self.data[~at_end] = text
        learnt = np.repeat(self.train, sizes + 1)
        self.keys, self.counts, self.place = zip(*[self._order_keys(k, code, learnt) for k, code in self._orders()])
        self._units(at_end)

    def _orders(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each order, hashed context and byte as one number below 2**24 at every place."""
        code = np.zeros(len(self.data), dtype=np.uint32)
        for k in range(1, ORDERS[-1] + 1):
            before = np.full(len(self.data), END, dtype=np.uint8)
            before[k:] = self.data[:-k]
            for ahead in range(k - 1):  # nothing before the text's own first byte counts
                before[np.minimum(self.starts + ahead, self.ends)] = END
            code |= before.astype(np.uint32) << np.uint32(8 * (k - 1))
            if k in ORDERS:
                hashed = code * np.uint32(0x9E3779B1) >> np.uint32(16) if k > 2 else code
                yield k, hashed << np.uint32(8) | self.data

    def _order_keys(self, k: int, code: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct keys of the contexts of ``k`` bytes, how often each is learnt, and the key of each byte."""
        if not _look_up:
            _look_up.extend([np.zeros(1 << 24, dtype=bool), np.zeros(1 << 24, dtype=np.int32)])
        there, number = _look_up
        there[code] = True
        used = np.flatnonzero(there)
        there[used] = False
        number[used] = np.arange(len(used), dtype=np.int32)
        place = number[code]
        keys = self._key(scan.mix((used >> 8).astype(np.uint64) ^ _SEEDS[k]), used & 0xFF)
        return keys, np.bincount(place[learnt], minlength=len(used)), place

    def _key(self, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The context's hash, of as many bits as its table has, above the byte."""
        return context >> np.uint64(64 - self.context_bits) << np.uint64(64 - self.context_bits) | byte.astype(np.uint64)

    def _units(self, at_end: np.ndarray) -> None:
        """Words, each with the byte after it, and what their bytes ask for."""
        stop = np.flatnonzero(at_end | ~scan.IN_WORD[self.data])
        start = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
        self.unit_text = np.searchsorted(self.ends, stop)
        first, self.unit = _distinct(scan.span_hashes(self.data, start, stop + 1))
        learnt = np.bincount(self.unit, weights=self.train[self.unit_text], minlength=len(first)).astype(np.int64)
        size = stop[first] + 1 - start[first]
        # The word contexts of the distinct units' bytes.
        at = scan.ragged(start[first], size)
        inner = scan.ragged(np.zeros(len(size), dtype=np.int64), size)
        padded = np.concatenate([np.zeros(WORD_CONTEXT, dtype=np.uint8), self.data])
        eight = np.ndarray(len(self.data) + 9, dtype="<u8", buffer=padded, strides=(1,))
        near = eight[at + 8] & _HIGH_BYTES[np.minimum(inner, 8)]
        far = eight[at] & _HIGH_BYTES[np.clip(inner - 8, 0, 8)]
        context = scan.mix(scan.mix(near ^ _SEEDS[ORDERS[-1] + 1]) ^ far + np.minimum(inner, WORD_CONTEXT).astype(np.uint64) * _SEEDS[0])
        key = self._key(context, self.data[at])
        some, place = _distinct(key)
        key = key[some]
        count = np.bincount(place, weights=np.repeat(learnt, size), minlength=len(key)).astype(np.int64)
        begin = np.cumsum(size) - size
        sizes = stop + 1 - start
        spread = place[scan.ragged(begin[self.unit], sizes)].astype(np.int32)
        self.keys, self.counts, self.place = [*self.keys, key], [*self.counts, count], [*self.place, spread]
        # Words for the base score, lower-cased.
        word = np.flatnonzero(size > 1)
        self.is_word = size > 1
        folded = scan.FOLD[self.data]
        one, two = (scan.span_hashes(folded, start[first[word]], stop[first[word]], seed=s) for s in (1, 2))
        at, of = _distinct(one)
        self.word_one = one[at]
        self.word_two = two[at] >> np.uint64(48)  # with the first hash 80 bits tell words apart
        self.word_count = np.bincount(of, weights=learnt[word], minlength=len(at)).astype(np.int64)
        self.word_of = np.zeros(len(size), dtype=np.int64)
        self.word_of[word] = of

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All contexts' keys in ascending order, their counts, and where each predictor's keys went."""
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)
        return keys[order], counts[order], order


# The exchange of keys and answers


def _packets(one: np.ndarray, two: np.ndarray, n: np.ndarray, keys: np.ndarray, counts: np.ndarray, done: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """Ascending words and keys, all alike in their first ``done`` bits, cut by the next ``bits``."""
    every = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - done - bits)
    base = ((one[0] if len(one) else keys[0]) >> np.uint64(64 - done) << np.uint64(64 - done)) if done and len(one) + len(keys) else np.uint64(0)
    at = [np.concatenate([[0], np.searchsorted(x, base + every, side="left"), [len(x)]]) for x in (one, keys)]
    for k in range(1 << bits):
        w, c = slice(at[0][k], at[0][k + 1]), slice(at[1][k], at[1][k + 1])
        if w.stop > w.start or c.stop > c.start:
            yield k, _pack(_rise(one[w]), two[w].view(np.int64), n[w], _rise(keys[c]), counts[c])


def _open(packets: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """All packets' words and keys one after the other, and how many each has."""
    parts = [_unpack(p) for p in packets]
    one, two, n, keys, counts = zip(*parts)
    joined = [np.concatenate([_fall(x) for x in one]), np.concatenate(two).view(np.uint64), np.concatenate(n), np.concatenate([_fall(x) for x in keys]), np.concatenate(counts)]
    return joined, np.array([len(x) for x in one]), np.array([len(x) for x in keys])


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the columns, where runs of equal values begin in it, and the run of each row."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    run = np.empty(len(order), dtype=np.int64)
    run[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), run


def _sum_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, dtype=np.int64)


def predict_bits(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For distinct ascending keys (context, byte) the eight bits' answers along the byte, as one number each."""
    out = np.empty((len(keys), 8), dtype=np.int8)
    for bit in range(8):
        node = keys >> np.uint64(8 - bit)
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
        total = _sum_runs(counts, starts)
        ones = _sum_runs(counts * (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64), starts)
        odds = np.log((ones + UNSEEN) / (total - ones + UNSEEN)) * ODDS_SCALE
        out[:, bit] = np.repeat(np.clip(np.rint(odds), -127, 127).astype(np.int8), np.diff(np.append(starts, len(keys))))
    return out.view("<i8").ravel()


def _signed(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Answers turned from odds of a one to odds of the byte's own bits, or back.

    Where a context has only ever led to one byte all eight agree, and take little room.
    """
    own = np.unpackbits((keys & np.uint64(0xFF)).astype(np.uint8)[:, None], axis=1).astype(np.int8) * 2 - 1
    return (bits.view(np.int8).reshape(-1, 8) * own).view("<i8").ravel()


ANSWER = "owner long, part long, packed binary, tokens long, distinct long"


def _answers(owners: list, parts: list, packed: list, tokens: int, distinct: int) -> pa.Table:
    n = len(owners)
    stats = [[v] + [0] * (n - 1) if n else [] for v in (tokens, distinct)]
    columns = zip(("owner", "part", "packed", "tokens", "distinct"), (owners, parts, packed, *stats), (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))
    return pa.table({name: pa.array(values, kind) for name, values, kind in columns})


def _answer(table: pa.Table) -> pa.Table:
    """Counts of the words of one range, and the predictors' answers to its keys, for each packet."""
    (one, two, n, keys, counts), words, asked = _open(table.column("packed").to_pylist())
    order, starts, run = _groups(one, two)
    totals = _sum_runs(n[order], starts)
    key_order, key_starts, key_run = _groups(keys)
    distinct = keys[key_order][key_starts]
    bits = _signed(predict_bits(distinct, _sum_runs(counts[key_order], key_starts)), distinct)
    word_cuts, key_cuts = np.cumsum(words)[:-1], np.cumsum(asked)[:-1]
    packed = [_pack_answer(a, b) for a, b in zip(np.split(totals[run], word_cuts), np.split(bits[key_run], key_cuts))]
    out = _answers(table.column("owner").to_pylist(), table.column("part").to_pylist(), packed, int(totals.sum()), int((totals > 0).sum()))
    scan.release()
    return out


def _merge(done: int, step: int, groups: int):
    """The packets of a group of owners in one range as one owner's, cut by the next bits.

    The row without a part says which of the merged words and keys each owner asked for.
    """

    def run(table: pa.Table) -> pa.Table:
        part, group = table.column("part")[0].as_py(), table.column("group")[0].as_py()
        (one, two, n, keys, counts), words, asked = _open(table.column("packed").to_pylist())
        order, starts, word_run = _groups(one, two)
        key_order, key_starts, key_run = _groups(keys)
        first, key_first = order[starts], key_order[key_starts]
        merged = (one[first], two[first], _sum_runs(n[order], starts), keys[key_first], _sum_runs(counts[key_order], key_starts))
        owner = part * groups + group
        rows = [(owner, -1, part, _pack(table.column("owner").to_numpy(), words, asked, word_run, key_run))]
        rows += [(owner, part << step | k, part, packed) for k, packed in _packets(*merged, done, step)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        scan.release()
        return pa.table({name: pa.array(values, kind) for name, values, kind in zip(("owner", "part", "above", "packed"), zip(*rows), kinds)})

    return run


def _spread(group: pa.Table, found: pa.Table) -> pa.Table:
    """The answers to a merged group, given to each of its owners."""
    owners, words, asked, word_run, key_run = _unpack(group.column("packed")[0].as_py())
    parts = [_unpack_answer(p) for p in found.sort_by("part").column("packed").to_pylist()]
    totals, bits = (np.concatenate(x) for x in zip(*parts))
    cuts = np.cumsum(words)[:-1], np.cumsum(asked)[:-1]
    packed = [_pack_answer(a, b) for a, b in zip(np.split(totals[word_run], cuts[0]), np.split(bits[key_run], cuts[1]))]
    stats = [sum(found.column(c).to_pylist()) for c in ("tokens", "distinct")]
    return _answers(owners.tolist(), [group.column("above")[0].as_py()] * len(owners), packed, *stats)


def _ask(requests: DataFrame, owners: int, done: int, total: int, level_bits: int, group_blocks: int) -> DataFrame:
    """Answers to ``requests`` (owner, part of ``done`` bits, packed), by ranges of ``total`` bits."""
    if done == total:
        return requests.groupBy("part").applyInArrow(_answer, ANSWER)
    step, groups = min(level_bits, total - done), max(1, -(-owners // group_blocks))
    grouped = requests.withColumn("group", F.pmod(F.xxhash64("owner"), F.lit(groups)))
    merged = materialize(grouped.groupBy("part", "group").applyInArrow(_merge(done, step, groups), "owner long, part long, above long, packed binary"), "mixing-level")
    finer = _ask(merged.where("part >= 0").select("owner", "part", "packed"), groups << done, done + step, total, level_bits, group_blocks)
    return merged.where("part < 0").groupBy("owner").cogroup(finer.groupBy("owner")).applyInArrow(_spread, ANSWER)


def _requests(context_bits: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = Block(packed, context_bits)
                keys, counts, _ = block.merged()
                rows = list(_packets(block.word_one, block.word_two, block.word_count, keys, counts, 0, bits))
                del block, keys, counts
                parts, packets = zip(*rows) if rows else ((), ())
                columns = [pa.array([owner] * len(rows), pa.int64()), pa.array(parts, pa.int64()), pa.array(packets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["owner", "part", "packed"])
                scan.release()

    return run


# Mixing


def mix_bits(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: list[np.ndarray], bits: list[np.ndarray]) -> np.ndarray:
    """Natural log of the probability of each segment.

    Segments of like size run side by side, a byte at a time; as the gate tells the bits of
    a byte apart, no bit waits for another one's update.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(order))
    for a in range(0, len(order), LANES):
        lanes = order[a : a + LANES]
        out[lanes] = _mix_lanes(data, starts[lanes], sizes[lanes], place, bits)
    return out


def _mix_lanes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: list[np.ndarray], bits: list[np.ndarray]) -> np.ndarray:
    lanes, inputs = len(starts), len(place)
    one, half, reach = np.float32(1), np.float32(0.5), np.float32(REFINE_REACH)
    unit = np.float32(1 / ODDS_SCALE)  # the answers stay whole; their unit is in the weights
    rate = np.float32(RATE / ODDS_SCALE / ODDS_SCALE)
    cells = np.float32((REFINED - 1) / (2 * REFINE_REACH))
    common = np.full((inputs, lanes, 8), FIRST_WEIGHT, dtype=np.float32) * unit
    offset = np.zeros_like(common)
    centre = np.linspace(-REFINE_REACH, REFINE_REACH, REFINED)
    refined = np.tile((1 / (1 + np.exp(-centre))).astype(np.float32), lanes * 8)
    row = (np.arange(lanes * 8) * REFINED).reshape(lanes, 8)
    total = np.zeros(lanes)
    # Arrays made once: giving memory back and taking it again at every byte costs as much as the sums.
    wide = [np.empty((inputs, lanes, 8), dtype=np.float32) for _ in range(2)]
    flat = [np.empty((lanes, 8), dtype=np.float32) for _ in range(6)]
    cells_at = np.empty((lanes, 8), dtype=np.int64)
    answer = np.empty(lanes, dtype=np.int64)
    product = np.ones((lanes, 8), dtype=np.float32)
    steps = int(sizes[0]) if lanes else 0
    for t in range(steps):
        live = int(np.searchsorted(-sizes, -t, side="left"))
        at = starts[:live] + t
        x, w = (a[:, :live] for a in wide)
        gate, s, p, r, guess, ones = (a[:live] for a in flat)
        cell = cells_at[:live]
        for k in range(inputs):
            np.take(bits[k], np.take(place[k], at, mode="clip"), out=answer[:live], mode="clip")
            x[k] = answer[:live].view(np.int8).reshape(live, 8)
        np.not_equal(x[-1], 0, out=gate)
        np.multiply(offset[:, :live], gate, out=w)
        w += common[:, :live]
        np.einsum("klb,klb->lb", w, x, out=s)
        np.clip(s, -11, 11, out=s)
        np.negative(s, out=p)
        np.exp(p, out=p)
        p += one
        np.divide(one, p, out=p)
        np.clip(s, -reach, reach, out=s)
        s += reach
        s *= cells
        np.rint(s, out=cell, casting="unsafe")
        cell += row[:live]
        np.take(refined, cell, out=r, mode="clip")
        np.take(BITS, np.take(data, at, mode="clip"), axis=0, out=ones, mode="clip")
        np.add(p, r, out=guess)
        guess *= half
        np.clip(guess, LEAST, 1 - LEAST, out=guess)
        guess -= one
        guess += ones
        np.abs(guess, out=guess)
        product[:live] *= guess
        if t % LOG_STEPS == LOG_STEPS - 1 or t == steps - 1:  # before the products get too small
            total += np.log(product).sum(axis=1, dtype=np.float64)
            product.fill(1)
        np.subtract(ones, p, out=p)
        p *= rate
        x *= p
        common[:, :live] += x
        x *= gate
        offset[:, :live] += x
        np.subtract(ones, r, out=guess)
        guess *= np.float32(REFINE_RATE)
        r += guess
        refined[cell] = r
    return total


def _score_block(context_bits: int, ends_learnt: int):
    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(blocks.column("packed")[0].as_py(), context_bits)
        parts = [_unpack_answer(p) for p in found.sort_by("part").column("packed").to_pylist()]
        totals, answers = (np.concatenate(x) for x in zip(*parts))
        keys, _, order = block.merged()
        bits = np.empty(len(order), dtype=np.int64)
        bits[order] = _signed(answers, keys)
        bits = np.split(bits, np.cumsum([len(k) for k in block.keys])[:-1])
        # Segments of the texts, each with its end sign.
        sizes = block.ends + 1 - block.starts
        pieces = -(-sizes // SEGMENT)
        text = np.repeat(np.arange(len(sizes)), pieces)
        offset = scan.ragged(np.zeros(len(sizes), dtype=np.int64), pieces) * SEGMENT
        logs = mix_bits(block.data, block.starts[text] + offset, np.minimum(sizes[text] - offset, SEGMENT), block.place, bits)
        score = np.bincount(text, weights=logs, minlength=len(sizes)) / np.log(10)
        # Tokens: words and the end.
        word = block.is_word[block.unit]
        count = totals[block.word_of[block.unit[word]]]
        of = block.unit_text[word]
        n_tokens = np.bincount(of, minlength=len(sizes)) + 1
        n_known = np.bincount(of, weights=count > 0, minlength=len(sizes)).astype(np.int64) + (ends_learnt > 0)
        logs = np.bincount(of, weights=np.log10(count + 1.0), minlength=len(sizes)) + np.log10(ends_learnt + 1.0)
        # What the ranges counted over all texts, handed on in one row of each block.
        stats = np.zeros((2, len(sizes)), dtype=np.int64)
        stats[:, 0] = [sum(found.column(c).to_pylist()) for c in ("tokens", "distinct")]
        out = pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64(), mask=~block.named),
                "trained": pa.array(block.train),
                "n_bytes": pa.array(sizes - 1, pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "logs": pa.array(logs),
                "score": pa.array(score),
                "tokens": pa.array(stats[0]),
                "distinct": pa.array(stats[1]),
            }
        )
        scan.release()
        return out

    return run


SCORED = "doc_id long, trained boolean, n_bytes long, n_tokens long, n_known long, logs double, score double, tokens long, distinct long"


def score(
    docs: DataFrame, train: Column, text: str = "text", id: str = "doc_id", spare_bits: int = SPARE_BITS,
    block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES, level_bits: int = LEVEL_BITS, group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """Score every row of ``docs``, learning from the rows where ``train`` holds.

    Gives ``doc_id``, ``trained``, ``n_bytes``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 of the model's probability of the text).
    """
    clean = F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), clean.alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    packed = rows.mapInArrow(_pack_blocks(block_bytes), "block long, n_bytes long, trained long, packed binary")
    blocks = bucketed(packed, "block", max(1, -(-int(total) // block_bytes)), "mixing_blocks")
    n, size, ends = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0))).first()
    total = max(0, int(max(0, size - 1) // range_bytes).bit_length())
    first = min(total, level_bits)
    context_bits = min(56, int(size).bit_length() + spare_bits)
    requests = blocks.select("block", "packed").mapInArrow(_requests(context_bits, first), "owner long, part long, packed binary")
    answers = _ask(requests, n, first, total, level_bits, group_blocks).withColumnRenamed("owner", "block")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score_block(context_bits, ends), SCORED)
    scored = materialize(scored, "mixing-scores")
    words, distinct = scored.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    tokens = words + ends
    base = math.log10(tokens + distinct + (ends > 0) + 1)
    return scored.select(
        "doc_id",
        "trained",
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        "score",
    )
