"""Vector codes against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from quipu.llm import vector_codes

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(n, T.StringType()) for n in ("_id", "_whole", "code", "error", "_vector", "_label", "part")],
    ]
)


def rows(n=300, dims=8, seed=1):
    rng = random.Random(seed)
    made = [(k, [rng.gauss(0, 0.2) for _ in range(dims)], rng.choice([0, 1, 2, None])) for k in rng.sample(range(10 * n), n)]
    made += [(made[0][0], made[1][1], 1), (None, made[2][1], 2), made[3], made[3]]
    bad = [(1, None, 0), (2, [None] * dims, 0), (3, [0.1] * (dims - 1) + [float("nan")], 1), (4, [float("-inf")] + [0.0] * (dims - 1), 1), (5, [], 0), (6, [0.5] * (dims + 4), 0), (7, [0.5] * 3, 0)]
    return [(k + 100 if k is not None else None, v, l) for k, v, l in made], [(k, v, l) for k, v, l in bad]


def table(spark, made):
    return spark.createDataFrame([(*r, *["clash"] * 7) for r in made], SCHEMA).repartition(5)


def brute(made, parts, entries, rounds, scale):
    whole = [(k, [int(np.floor(scale * float(np.float32(x)))) for x in v], l) for k, v, l in made]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in whole:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    coded = []
    for k, v, l in whole:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        coded.append((k, [c for _, c in found], sum(d for d, _ in found), l))
    total = {}
    for _, _, e, l in coded:
        total[l] = total.get(l, 0) + e
    return books, [(k, c, e, total[l]) for k, c, e, l in coded]


def order(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("entries, rounds", [(16, 3), (70, 1), (1000, 2), (1, 1)])
def test_codes_are_those_of_brute_force(spark, entries, rounds):
    good, bad = rows()
    df = table(spark, good + bad)
    books = vector_codes.fit(df, parts=2, entries=entries, rounds=rounds, scale=64)
    found = vector_codes.label_errors(vector_codes.encode(df, books)).collect()
    wanted_books, wanted = brute(good, 2, entries, rounds, 64)
    assert books.entries.tolist() == wanted_books
    got = [(r.vec_id, list(r.code), r.error, r.label_error) for r in found]
    assert sorted(got, key=order) == sorted(wanted, key=order)
    assert {r._whole for r in found} == {"clash"}


def test_huge_components_saturate(spark):
    made = [(1, [1e30, 0.0], 0), (2, [-1e30, 0.0], 0), (3, [200000.0, 3.0], 0)]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    books = vector_codes.fit(df, parts=1, entries=2, rounds=0)
    assert books.entries[0].tolist() == [[vector_codes.LIMIT, 0], [-vector_codes.LIMIT, 0]]
    found = {r.vec_id: (list(r.code), r.error) for r in vector_codes.encode(df, books).collect()}
    assert found == {1: ([0], 0), 2: ([1], 0), 3: ([0], 3072**2)}


def test_nothing_to_code(spark):
    _, bad = rows()
    for df in (table(spark, bad[:5]), table(spark, bad).where("false")):
        books = vector_codes.fit(df)
        assert vector_codes.label_errors(vector_codes.encode(df, books)).collect() == []


def test_decoded_vectors(spark):
    good, _ = rows(n=40)
    df = table(spark, good)
    books = vector_codes.fit(df, parts=4, entries=1000, rounds=0, scale=1 << 20)
    coded = vector_codes.encode(df, books).selectExpr("vec_id", "if(vec_id % 2 = 0, code, null) AS code", "error")
    for r in vector_codes.decode(coded, books).collect():
        if r.code is None:
            assert r.decoded is None
        else:
            assert len(r.decoded) == 8 and r.error == 0


def test_nearest_of_random_points():
    rng = np.random.default_rng(0)
    for dims, entries, high in [(1, 5, 4), (3, 64, 9), (4, 65, 1000), (2, 300, 40)]:
        book, x = rng.integers(-high, high, (entries, dims)), rng.integers(-2 * high, 2 * high, (500, dims))
        code, best = vector_codes.Slices(book).nearest(x)
        every = ((x[:, None] - book) ** 2).sum(axis=2)
        assert (code == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
