"""The helpers inside tasks, against plain Python."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from quipu.llm import bpe, decontaminate, ngram_join, scan, suffixes, token_files
from quipu.llm.fuse import FuseFilter

PATTERN = regex.compile(public_tokenizers.PATTERN)
ODD = st.text(alphabet="ab'strevldm  \n\t　\x85 é9²½.!$日ßđ😀́-_", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=8))
def test_pretokens_are_the_matches_of_the_pattern(texts):
    found = [
        bytes(part).decode()
        for _, _, data, borders in scan.slices(pa.array(texts, pa.string()), limit=30)
        for part in np.split(data, bpe.pretoken_starts(data, borders)[1:])
        if len(part)
    ]
    assert found == [m for t in texts for m in PATTERN.findall(t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\x0bé\n.", max_size=20), max_size=6), st.integers(1, 4))
def test_word_ngrams(texts, n):
    word = regex.compile(r"[^\x20\x09-\x0D]+")
    split = [[w.encode().lower() for w in word.findall(t)] for t in texts]
    wanted = [[tuple(w[i : i + n]) for i in range(len(w) - n + 1)] or ([tuple(w)] if w else []) for w in split]
    codes = {}
    for _, _, data, borders in scan.slices(pa.array(texts, pa.string())):
        start, end, hashes, begins = scan.word_hashes(data, borders)
        assert [bytes(scan.FOLD[data[a:b]]) for a, b in zip(start, end)] == [w for ws in split for w in ws]
        grams, starts = scan.ngram_hashes(hashes, begins, n, whole_if_short=True)
        assert list(np.diff(starts)) == [len(w) for w in wanted]
        for code, gram in zip(grams.tolist(), [g for w in wanted for g in w]):
            assert codes.setdefault(code, gram) == gram
        distinct, at = scan.unique_per_text(grams, starts)
        assert list(np.diff(at)) == [len(set(w)) for w in wanted]
    assert len(set(codes.values())) == len(codes)


def test_pressed_arrays_come_back():
    arrays = [np.arange(5, dtype="<u4"), np.zeros(0, dtype="<i8"), np.array([True, False]), np.array([2**63], dtype=np.uint64)]
    for a, b in zip(arrays, scan.unpress_arrays(scan.press_arrays(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()
    numbers = np.array([0, 1, 255, 256, 2**31, 2**32 - 1])
    assert (scan.unpress_numbers(scan.press_numbers(numbers)) == numbers).all()


def test_fuse_filters_hold_all_keys_and_few_others():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 100, 5000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        made = FuseFilter.from_bytes(FuseFilter.build(np.concatenate([keys, keys])).to_bytes())
        assert made.contains(keys).all()
        assert made.contains(rng.integers(0, 1 << 63, 20000).astype(np.uint64)).mean() < 0.01


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=8), min_size=1, max_size=7))
def test_loser_tree_merges_sorted_runs(runs):
    width = 6
    sorted_runs, sizes = [], []
    for run in runs:
        run = sorted(run, key=lambda s: s.ljust(width, b"\0"))
        sizes += [len(s) for s in run]
        sorted_runs.append(np.frombuffer(b"".join(s.ljust(width, b"\0") for s in run), dtype=np.uint8).reshape(-1, width))
    order, prefix = suffixes.merge(sorted_runs, [suffixes.common_prefixes(r) for r in sorted_runs])
    rows = np.concatenate(sorted_runs)[order]
    assert sorted(order.tolist()) == list(range(len(rows)))
    assert [bytes(r) for r in rows] == sorted(bytes(r) for r in rows)
    assert prefix.tolist() == suffixes.common_prefixes(rows).tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=9), max_size=12))
def test_front_coding_comes_back(strings):
    strings = sorted(strings)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    rows = np.frombuffer(b"".join(s.ljust(9, b"\0") for s in strings), dtype=np.uint8).reshape(-1, 9)
    shared, rest = suffixes.front_code(rows, size)
    assert (suffixes.front_decode(shared.astype(np.int64), rest, size, 9) == rows).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**16 - 1), max_size=30), max_size=5))
def test_codes_of_ranks_come_back(documents):
    for bits, limit in ((1, 2**16), (2, 2**32)):
        rows = [np.array(d, dtype=np.uint64) * np.uint64(1 if bits == 1 else 65537) % np.uint64(limit) for d in documents]
        packed = [token_files.pack(r.astype("<u4"), bits) for r in rows]
        control = np.frombuffer(b"".join(p[0] for p in packed), dtype=np.uint8)
        data = np.frombuffer(b"".join(p[1] for p in packed), dtype=np.uint8)
        counts = np.array([len(r) for r in rows], dtype=np.int64)
        assert token_files.unpack(control, data, counts, bits).tolist() == [int(x) for r in rows for x in r]


def test_alignment_scores():
    def plain(a, b):
        best, row = 0, [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                diagonal = row[j] + (decontaminate.MATCH if x == y else -decontaminate.MISMATCH)
                new.append(max(0, diagonal, row[j + 1] - decontaminate.GAP, new[j] - decontaminate.GAP))
            row, best = new, max(best, *new)
        return best

    rng = random.Random(9)
    pairs = [([rng.randint(1, 4) for _ in range(rng.randint(1, 12))], [rng.randint(1, 4) for _ in range(rng.randint(0, 15))]) for _ in range(200)]
    found = decontaminate.align([np.array(a, dtype=np.uint64) for a, _ in pairs], [np.array(b, dtype=np.uint64) for _, b in pairs])
    assert found.tolist() == [plain(a, b) for a, b in pairs]


def test_sets_of_texts():
    texts = pa.array(["a b c d", "a b c d a b c d", "", "one two", None, "A B C D"])
    sizes = [int(n) for codes, begins in ngram_join._sets(texts, 4) for n in np.diff(begins)]
    assert sizes == [1, 4, 0, 1, 0, 1]
