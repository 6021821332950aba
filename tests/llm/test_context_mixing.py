"""Language-model scores against a plain model that goes bit by bit."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from fixtures import documents, edge_texts, sentence
from quipu.llm import context_mixing as mixing
from quipu.llm import features, scan
from quipu.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def contexts(data, at):
    """What stands before a byte, for each predictor."""
    for k in mixing.ORDERS:
        before = bytes(data[max(0, at - k) : at]).rjust(k, bytes([mixing.END]))
        if k == 3:
            before = int.from_bytes(before, "big") * 0x9E3779B1 % (1 << 32) >> 16
        yield k, before
    start = at
    while start > 0 and data[start - 1] not in SPACE:
        start -= 1
    yield "word", (bytes(data[max(start, at - 16) : at]), min(at - start, 16))


class PlainModel:
    def __init__(self, texts):
        self.counts = Counter()
        for t in texts:
            data = (t or "").encode() + bytes([mixing.END])
            for at, byte in enumerate(data):
                for context in contexts(data, at):
                    for bit in range(8):
                        self.counts[context, bit, (byte | 256) >> 8 - bit, byte >> 7 - bit & 1] += 1

    def log10(self, text):
        data = (text or "").encode() + bytes([mixing.END])
        total = 0.0
        for at, byte in enumerate(data):
            if at % mixing.SEGMENT == 0:
                common = [[mixing.FIRST_WEIGHT] * 3 for _ in range(8)]
                offset = [[0.0] * 3 for _ in range(8)]
                reach = mixing.REFINE_REACH
                refined = [[1 / (1 + math.exp(reach - 2 * reach * j / (mixing.REFINED - 1))) for j in range(mixing.REFINED)] for _ in range(8)]
            answers = []
            for context in contexts(data, at):
                answers.append([])
                for bit in range(8):
                    zeros, ones = (self.counts[context, bit, (byte | 256) >> 8 - bit, v] for v in (0, 1))
                    scaled = round(math.log((ones + mixing.UNSEEN) / (zeros + mixing.UNSEEN)) * mixing.ODDS_SCALE)
                    answers[-1].append(max(-127, min(127, scaled)) / mixing.ODDS_SCALE)
            for bit in range(8):
                one, odds = byte >> 7 - bit & 1, [a[bit] for a in answers]
                gate = odds[-1] != 0
                w = [a + gate * b for a, b in zip(common[bit], offset[bit])]
                s = max(-11, min(11, sum(a * b for a, b in zip(w, odds))))
                p = 1 / (1 + math.exp(-s))
                cell = round((max(-reach, min(reach, s)) + reach) * (mixing.REFINED - 1) / (2 * reach))
                guess = max(mixing.LEAST, min(1 - mixing.LEAST, (p + refined[bit][cell]) / 2))
                total += math.log10(guess if one else 1 - guess)
                for k in range(3):
                    common[bit][k] += odds[k] * (one - p) * mixing.RATE
                    offset[bit][k] += gate * odds[k] * (one - p) * mixing.RATE
                refined[bit][cell] += (one - refined[bit][cell]) * mixing.REFINE_RATE
        return total


def base(texts, learnt):
    """Tokens, known tokens, learnt tokens and base score of each text."""
    count = Counter()
    for t in learnt:
        count.update([*WORD.findall((t or "").translate(FOLD)), None])
    n = sum(count.values())
    for t in texts:
        tokens = [*WORD.findall((t or "").translate(FOLD)), None]
        yield len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in tokens)


def short_texts():
    rng = random.Random(2)
    rows = [(i, t if t is None else t[:700]) for i, t in edge_texts()]
    return rows + [(40, sentence(rng, 500)), (None, "no id"), (41, "w" * 40 + " " + "w" * 40), (2**60 + 1, "far")]


@pytest.mark.parametrize("limits", [{}, dict(block_bytes=900, range_bytes=300, level_bits=2, group_blocks=2)])
def test_scores_of_a_plain_model(spark, limits):
    """Also by exchanges of several levels, and however the texts are dealt out."""
    rows = short_texts()
    learnt = [t for i, t in rows if i is not None and i % 3]
    found = mixing.score(documents(spark, rows), F.col("doc_id") % 3 != 0, spare_bits=40, **limits).collect()
    model = PlainModel(learnt)
    texts = [t for _, t in rows]
    wanted = [(i, *b, model.log10(t)) for (i, t), b in zip(rows, base(texts, learnt))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[5])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=key)
    assert len(got) == len(wanted)
    for g, w in zip(got, sorted(wanted, key=key)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=1e-4), (g, w)


def test_segments_start_anew(spark):
    rows = [(1, sentence(random.Random(4), 700)), (2, "x")]
    assert len(rows[0][1].encode()) > mixing.SEGMENT
    found = {r.doc_id: r.score for r in mixing.score(documents(spark, rows), F.lit(True), spare_bits=40).collect()}
    model = PlainModel([t for _, t in rows])
    assert all(found[i] == pytest.approx(model.log10(t), rel=1e-4) for i, t in rows)


def test_nothing_learnt_and_nothing_there(spark):
    rows = [(1, "a b"), (2, None)]
    found = {r.doc_id: r for r in mixing.score(documents(spark, rows), F.lit(None).cast("boolean")).collect()}
    assert (found[1].n_tokens, found[1].n_known, found[1].train_tokens, found[1].base_score) == (3, 0, 0, 0.0)
    assert found[1].score == pytest.approx(-4 * 8 * math.log10(2), rel=0.01)  # only the refining table learns
    empty = documents(spark, rows).where("false")
    assert mixing.score(empty, F.lit(True)).collect() == []


def test_words_that_fool_linear_hashes(spark):
    """Strings whose polynomial hashes modulo 2**64 agree stay different words."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    found = {r.doc_id: r for r in mixing.score(documents(spark, [(1, one), (2, two), (3, one[:1024]), (4, two[:1024])]), F.col("doc_id") % 2 == 1).collect()}
    assert [found[i].n_known for i in (1, 2, 3, 4)] == [2, 1, 2, 1]


def test_answers_to_keys():
    keys = np.array([5 << 16 | 0x61, 5 << 16 | 0x62, 9 << 16 | 0x61], dtype=np.uint64)
    odds = mixing.predict_bits(keys, np.array([3, 1, 0])).view(np.int8).reshape(-1, 8)
    scaled = lambda ones, zeros: round(math.log((ones + 0.4) / (zeros + 0.4)) * mixing.ODDS_SCALE)
    assert odds[0].tolist() == [scaled(0, 4), scaled(4, 0), scaled(4, 0), scaled(0, 4), scaled(0, 4), scaled(0, 4), scaled(1, 3), scaled(3, 0)]
    assert odds[2].tolist() == [0] * 8


def test_the_query_learns_from_the_other_folds(spark):
    found = {r.doc_id: r for r in QUERIES["op11_lm_score"](spark, SMALL).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    texts = [t for _, t in rows]
    for (i, _), b in zip(rows, base(texts, [t for i, t in rows if not held[i]])):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], *b[:3])
        assert r.base_score == pytest.approx(b[3], rel=1e-9) and r.score < 0
    # What was learnt is cheaper than what was not, and both are cheaper than eight bits a byte.
    bits = [sum(-r.score for r in found.values() if r.held_out == h) / sum(r.n_bytes for r in found.values() if r.held_out == h) / math.log10(2) for h in (False, True)]
    assert bits[0] < bits[1] < 5


def test_word_hashes_have_no_structure():
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(4096)).encode()
    two = one.translate(bytes.maketrans(b"ab", b"ba"))
    for n in (256, 512, 1024, 2048, 4096):
        data = np.frombuffer(one[:n] + two[:n], dtype=np.uint8)
        a, b = scan.span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
        assert a != b


def test_held_out_of_a_null_id(spark):
    row = spark.range(1).select(features.held_out(F.lit(None).cast("long"), 7, 2).alias("h")).first()
    assert row.h == (zlib.crc32(b"") % 7 == 2)
