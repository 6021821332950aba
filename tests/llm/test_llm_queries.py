"""The registered queries that SQL cannot express, against brute force or held-out labels."""

import hashlib
import struct
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import regex

import corpus_pipeline
from quipu.llm import bpe
from quipu.llm.queries import MULTILINGUAL, QUERIES
from fixtures import documents, edge_texts
from test_operators import expected_components, expected_cut

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "reserved",
}


def texts(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def column(folder, table, name):
    return dict(duckdb.sql(f"SELECT doc_id, {name} FROM '{folder}/{table}.parquet'").fetchall())


def multilingual():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._ranks(MULTILINGUAL.path), special_tokens={})


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_repeated_strings(spark):
    found = QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    wanted = {i: (n, spans, kept) for i, n, spans, kept in expected_cut(texts(SMALL), 100)}
    assert len(found) == len(wanted)
    for r in found:
        n, spans, kept = wanted[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())


def test_token_ids(spark):
    found = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, SMALL).collect()}
    coder = multilingual()
    for i, t in texts(SMALL):
        ids = coder.encode_ordinary(t)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), digest)
        assert found[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_language_of_held_out_documents(spark):
    langs = column(MIDDLE, "documents", "lang")
    found = QUERIES["op4_language"](spark, MIDDLE).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found) and len(found) == len(langs)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)


def test_components(spark):
    found = QUERIES["op5_ngram_jaccard"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected_components(texts(SMALL), 4, 85, 100)


def test_quality_of_held_out_documents(spark):
    labels = column(MIDDLE, "labels", "quality")
    found = QUERIES["op6_quality"](spark, MIDDLE).collect()
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_licence_notices(spark):
    found = Counter((r.doc_id, r.paragraph, r.family) for r in QUERIES["op7_licenses"](spark, MIDDLE).collect())
    wanted = Counter()
    for i, t in texts(MIDDLE):
        for k, line in enumerate(t.split("\n")):
            wanted.update((i, k, family) for notice, family in NOTICES.items() if notice in line)
    assert found == wanted


def test_token_files(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, SMALL).collect()}
    at = 0
    for i, t in texts(SMALL):
        ids = coder.encode(t, add_special_tokens=False).ids + [2]
        assert (found[i].start, found[i].n_tokens) == (at, len(ids))
        assert found[i].ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)


def test_benchmark_passages(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{MIDDLE}/benchmark.parquet'").fetchall()
    found = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, MIDDLE).collect()}
    assert found == {(i, k) for i, t in texts(MIDDLE) for k, passage in items if passage in t}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage of the pipeline keeps."""
    docs, out = spark.read.parquet(f"{MIDDLE}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, MIDDLE).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{MIDDLE}/documents.parquet").columns
    assert all(s.columns == columns for s in stages[:-1])


def test_stages_against_brute_force(stages):
    kept = [dict(s.select("doc_id", "text").collect()) for s in stages[:-1]]
    whole, labels = dict(texts(MIDDLE)), column(MIDDLE, "labels", "quality")
    right = [(i in kept[0]) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.97 * len(right)

    last = {}
    for i, t in kept[0].items():
        last[t] = max(i, last.get(t, i))
    assert kept[1] == {i: t for t, i in last.items()}

    groups = expected_components(sorted(kept[1].items()), 5, 80, 100)
    assert set(kept[2]) == {i for i, _, component in groups if i == component}

    items = [t for (t,) in duckdb.sql(f"SELECT text FROM '{MIDDLE}/benchmark.parquet'").fetchall()]
    assert set(kept[3]) == {i for i, t in kept[2].items() if not any(p in t for p in items)}

    coder = multilingual()
    rows = stages[-1].collect()
    assert sorted(r.doc_id for r in rows) == sorted(kept[3])
    for r in rows:
        ids = coder.encode_ordinary(whole[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(whole[r.doc_id].encode()).hexdigest()


def test_stages_on_edge_texts(spark, tmp_path):
    """Nulls, empty, long and repeated texts, clashing names; every stage keeps what its contract says."""
    rows = [*edge_texts(), (None, "no id"), (None, None), (2**60 + 1, "far away")]
    docs = documents(spark, rows)
    whole = Counter(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        found = spark.read.parquet(path)
        if k < 4:
            assert found.columns == docs.columns
            left = Counter((r.doc_id, r.text) for r in found.collect())
            assert not left - whole
        if k == 1:
            texts = [t or "" for _, t in left]
            assert len(texts) == len(set(texts))  # rows that repeat id and text are one entry here
            last = {}
            for i, t in whole:
                last[t or ""] = max(-1 if i is None else i, last.get(t or "", -1))
            assert {t or "": -1 if i is None else i for i, t in left} == last
        if k == 2:
            named = [(i, t) for i, t in whole if i is not None]
            smallest = {i for i, _, component in expected_components(named, 5, 80, 100) if i == component}
            assert {i for i, _ in left if i is not None} == smallest
            assert Counter(x for x in left if x[0] is None) == Counter(x for x in whole if x[0] is None)
        whole, docs = left, found
    assert sorted((r.n_tokens == 0 for r in docs.collect())).count(True) == sum(not t for _, t in whole)


def test_stages_on_nothing(spark):
    empty = documents(spark, [(1, "x")]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []


def test_words_of_the_public_pattern():
    """The pattern that the pre-tokens follow is the one the vocabulary files come with."""
    assert regex.findall(public_tokenizers.PATTERN, "it's  12!") == ["it", "'s", " ", " 12", "!"]
