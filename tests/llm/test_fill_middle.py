"""Rearranged texts against a plain form, and the way back."""

import hashlib
import random
import regex
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import documents, edge_texts
from quipu.llm import fill_middle

MORE = [(50, "a <P> b\nc"), (51, "x\n<S>"), (52, "<M>"), (53, "< P>\n<\nP>\nM>"), (None, "a\nb\nc\n"), (54, "no end\nof line"), (55, "\n"), (2**60 + 1, "é\n日本\n😀"), (56, "<P\n>S>\n")]


def plain(id, text, percent=100, spm=50):
    text = text or ""
    units = regex.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm:
        return id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def many():
    rng = random.Random(3)
    lines = ["", "a", "é b", "<P", "long " * 9, "日本"]
    return [(100 + k, "".join(rng.choice(lines) + rng.choice(["\n", "\n", "\r\n", ""]) for _ in range(rng.randrange(6)))) for k in range(400)]


@pytest.mark.parametrize("percent, spm", [(100, 50), (40, 50), (100, 0), (100, 100), (0, 50)])
def test_outputs_and_the_way_back(spark, percent, spm):
    rows = edge_texts() + MORE + many()
    found = fill_middle.restore(fill_middle.transform(documents(spark, rows), percent=percent, spm_percent=spm)).collect()
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode()) for r in found)
    assert got == Counter(plain(i, t, percent, spm) for i, t in rows)
    assert Counter((r.doc_id, bytes(r.restored).decode()) for r in found) == Counter((i, t or "") for i, t in rows)
    assert {r.score for r in found} == {None, "clash"} or {r.score for r in found} == {"clash"}


def test_restored_from_output_and_form_alone(spark):
    outputs = [("psm", b"<P>a\n<S>c<M>b\n"), ("spm", b"<S>c<P>a\n<M>b\n"), ("plain", b"<P>x"), ("psm", b"<P><S><M>"), (None, b"a"), ("plain", None)]
    df = spark.createDataFrame(outputs, "form string, output binary").coalesce(1)
    found = [None if r.restored is None else bytes(r.restored) for r in fill_middle.restore(df).collect()]
    assert found == [b"a\nb\nc", b"a\nb\nc", b"<P>x", b"", None, b""]


def test_an_output_without_its_marks_is_an_error(spark):
    df = spark.createDataFrame([("psm", b"<P>a<S>b")], "form string, output binary")
    with pytest.raises(Exception, match="each mark once"):
        fill_middle.restore(df).collect()


def test_empty_table(spark):
    assert fill_middle.restore(fill_middle.transform(documents(spark, [(1, "x")]).where("false"))).collect() == []


def test_long_text(spark):
    text = "".join(f"line {k}\n" for k in range(600_000))
    r = fill_middle.restore(fill_middle.transform(documents(spark, [(3, text), (4, "a\nb")]))).where("doc_id = 3").select(F.sha2("restored", 256).alias("h"), F.sha2("output", 256).alias("o")).first()
    assert r.h == hashlib.sha256(text.encode()).hexdigest()
    assert r.o == hashlib.sha256(plain(3, text)[5].encode()).hexdigest()
