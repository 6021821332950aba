"""Each operator on small tables against brute force."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from quipu.llm import bpe, decontaminate, exact_dedup, features, language, licenses, ngram_join, quality, suffix_dedup, token_files, warc
from quipu.llm.components import components
from fixtures import CLASHING, WORDS, documents, edge_texts, sentence

MULTILINGUAL = bpe.RankFile(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ENGLISH = bpe.TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def edge(spark):
    return documents(spark, edge_texts()).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [(1, "x")]).where("false")


# exact dedup


def expected_classes(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""])) for i, t in rows)


def found_classes(df):
    return sorted((r.doc_id, r.keep_id, r.group_size) for r in df.collect())


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_classes(edge, batches):
    found = exact_dedup.classes(edge, batches=batches, shard_keys=3)
    assert found_classes(found) == expected_classes(edge_texts())


def test_exact_classes_of_colliding_digests(edge):
    """Digests of a few bits agree for different texts; the byte check tells them apart."""

    def weak(text):
        return F.concat(F.lit(b"1234567"), F.substring(F.unhex(F.sha2(text, 256)), 1, 1).substr(1, 0), F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0")))

    found = exact_dedup.classes(edge, digest=weak, control=weak)
    assert found_classes(found) == expected_classes(edge_texts())


def test_exact_classes_of_nothing(nothing):
    assert exact_dedup.classes(nothing).count() == 0
    assert exact_dedup.survivors(nothing).columns == nothing.columns


def test_exact_survivors(edge):
    kept = exact_dedup.survivors(edge)
    assert kept.columns == edge.columns
    rows = edge_texts()
    groups = {}
    for i, t in rows:
        groups[t or ""] = max(i, groups.get(t or "", 0))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in rows if groups[t or ""] == i)


# repeated strings


def expected_cut(rows, length):
    seen, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            seen[w] = min(seen.get(w, (i, s)), (i, s))
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] < (i, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = [j for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1])]
        out.append((i, len(b), len(spans), kept))
    return sorted(out)


def found_cut(df):
    rows = df.collect()
    for r in rows:
        assert r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans)
    return sorted((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in rows)


def test_repeated_strings(edge):
    assert found_cut(suffix_dedup.dedup(edge, block_bytes=4000)) == expected_cut(edge_texts(), 100)


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings_of_few_letters(spark, seed):
    """Short strings over two letters, many runs, and merging in several levels."""
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("ab\x00"[: 2 + seed % 2]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(rng.randint(0, 59), rows[k][1]) for k in range(4)]
    found = suffix_dedup.dedup(documents(spark, rows), length=10, anchor=4, block_bytes=100, fan=2)
    assert found_cut(found) == expected_cut(rows, 10)


def test_repeated_strings_of_nothing(nothing):
    assert suffix_dedup.dedup(nothing).count() == 0


# ids that are null or beyond what a float holds

FAR = (1 << 53) + 1


def far_texts():
    return edge_texts() + [(None, "alone"), (None, "alone"), (None, "word"), (None, None), (None, "only"), (FAR, "far away"), (FAR + 2, "further"), (-FAR, "alone too")]


def test_survivors_without_an_id(spark):
    docs = documents(spark, far_texts())
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text or "") for r in kept.collect())
    rows = [(i, t or "") for i, t in far_texts()]
    best = {}
    for i, t in rows:
        best[t] = i if best.get(t) is None or (i is not None and i > best[t]) else best[t]
    wanted = Counter((i, t) for i, t in rows if i is not None and best[t] == i)
    wanted.update((None, t) for t, i in best.items() if i is None)
    assert found == wanted and found[None, "alone"] == 1


def test_bpe_keeps_ids(spark):
    found = bpe.encode(documents(spark, far_texts()), MULTILINGUAL, block_bytes=4000, bucket_bytes=8000)
    assert Counter(r.doc_id for r in found.select("doc_id").collect()) == Counter(i for i, _ in far_texts())


@pytest.mark.parametrize("file_text_bytes", [30000, 1 << 24])
def test_token_files_keep_ids(spark, tmp_path, file_text_bytes):
    path = str(tmp_path / "files")
    order = token_files.write(documents(spark, far_texts()), ENGLISH, 50257, 2, path, file_text_bytes=file_text_bytes, block_ids=2000, block_bytes=9000)
    found = sorted(token_files.checksums(token_files.read(spark, path, order)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((i for i, _ in far_texts()), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()


def test_decontamination_keeps_ids(spark):
    passage = " ".join(f"v{k}" for k in range(30))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = documents(spark, far_texts() + [(None, "some " + passage), (FAR + 4, passage + " more")], partitions=1)
    assert {(r.doc_id, r.item_id) for r in decontaminate.pairs(docs, bench).collect()} == {(None, 1), (FAR + 4, 1)}


# words whose linear hashes agree


def thue_morse(n):
    """Two strings of two letters that no polynomial hash modulo a power of two tells apart."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


LOOKALIKES = [text for n in (256, 1024, 2048, 4096) for text in thue_morse(n)]


def test_lookalike_words_keep_their_ids(spark, tmp_path):
    import tiktoken
    from tokenizers import Tokenizer

    rows = list(enumerate(LOOKALIKES))
    docs = documents(spark, rows, partitions=1)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._ranks(MULTILINGUAL.path), special_tokens={})
    found = {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(bpe.encode(docs, MULTILINGUAL), MULTILINGUAL).collect()}
    ids = {i: coder.encode_ordinary(t) for i, t in rows}
    assert found == {i: (struct.pack(f"<{len(ids[i])}I", *ids[i]), t.encode()) for i, t in rows}

    path = str(tmp_path / "files")
    order = token_files.write(docs, ENGLISH, 50257, 2, path)
    library = Tokenizer.from_file(ENGLISH.path)
    found = {r.doc_id: bytes(r.ids) for r in token_files.read(spark, path, order).collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}
    assert found == {i: struct.pack(f"<{len(own)}I", *own) for i, own in ids.items()}


def test_lookalike_words_are_not_linked(spark):
    found = {r.doc_id: r.component_id for r in ngram_join.classes(documents(spark, list(enumerate(LOOKALIKES))), n=4, num=85).collect()}
    assert found == {i: i for i in range(len(LOOKALIKES))}


# tables for joins


def test_buckets_keep_within_the_highest_number(spark):
    """Many more blocks than a session may have buckets; nothing stays in the catalog."""
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        rows = edge_texts()
        encoded = bpe.encode(documents(spark, rows), MULTILINGUAL, block_bytes=500, bucket_bytes=500)
        assert Counter(r.doc_id for r in encoded.collect()) == Counter(i for i, _ in rows)
        found = suffix_dedup.dedup(documents(spark, rows), block_bytes=2000).select("doc_id", "n_bytes").collect()
        assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert spark.catalog.listTables() == []


# byte-level BPE


def test_bpe_is_that_of_the_library(edge):
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._ranks(MULTILINGUAL.path), special_tokens={})
    encoded = bpe.encode(edge, MULTILINGUAL, block_bytes=4000, bucket_bytes=8000)
    found = sorted((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(encoded, MULTILINGUAL).collect())
    wanted = []
    for i, t in edge_texts():
        ids = coder.encode_ordinary(t or "")
        wanted.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()))
    assert found == sorted(wanted)


def test_packets_of_a_block_do_not_grow_with_the_table(spark):
    """Beyond as many blocks the exchange goes by groups: rows in proportion to the blocks, and the same ids."""
    rng = random.Random(9)
    rows = [(i, sentence(rng, 300)) for i in range(120)]
    small = documents(spark, rows[:60], partitions=2)
    large = documents(spark, rows, partitions=2)
    limits = dict(block_bytes=1500, bucket_bytes=1500, fan=4)
    counts = []
    for docs in (small, large):
        blocks = bpe.encode_words(docs, MULTILINGUAL, **limits).blocks
        n = blocks.where("bucket = -1").count()
        counts.append((blocks.where("bucket >= 0").count(), n))
        assert counts[-1][0] <= 4 * n and blocks.agg(F.max("bucket")).first()[0] > 4
    assert counts[1][0] <= 2.2 * counts[0][0]
    grouped = {r.doc_id: bytes(r.ids) for r in bpe.encode(large, MULTILINGUAL, **limits).collect()}
    assert grouped == {r.doc_id: bytes(r.ids) for r in bpe.encode(large, MULTILINGUAL).collect()}


def test_decoding_keeps_nulls_and_columns(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, bytearray(b""), None)], "doc_id long, ids binary, score string")
    found = bpe.decode(rows, MULTILINGUAL).collect()
    assert [(r.doc_id, r.decoded, r.score) for r in sorted(found)] == [(1, None, "x"), (2, bytearray(b""), None)]


def test_bpe_of_nothing(nothing):
    assert bpe.encode(nothing, MULTILINGUAL).count() == 0


# token files


def test_token_files(spark, edge, tmp_path):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(ENGLISH.path)
    path = str(tmp_path / "files")
    order = token_files.write(edge, ENGLISH, 50257, 2, path, file_text_bytes=30000, block_ids=2000, block_bytes=9000)
    found = sorted(token_files.checksums(token_files.read(spark, path, order)).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    at, wanted = 0, []
    for i, t in edge_texts():
        ids = coder.encode(t or "", add_special_tokens=False).ids + [2]
        wanted.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert [tuple(r) for r in found] == wanted


def test_token_files_with_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(ENGLISH.path)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"one  {end}\n\n two{end}three", f"<|{end}|> <|endoftext|", "oftext|> plain", f"it{end}'s", f"日本 {end} é"]
    rows = [*enumerate(texts, 1), (20, "<|endo"), (21, "ftext|>")]
    path = str(tmp_path / "files")
    order = token_files.write(documents(spark, rows, partitions=1), ENGLISH, 50257, 2, path)
    found = {r.doc_id: bytes(r.ids) for r in token_files.read(spark, path, order).collect()}
    ids = {i: coder.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}
    assert ids[1] == [64, 220, 50256, 275, 2]
    assert found == {i: struct.pack(f"<{len(own)}I", *own) for i, own in ids.items()}


def test_token_files_of_nothing(spark, nothing, tmp_path):
    path = str(tmp_path / "none")
    order = token_files.write(nothing, ENGLISH, 50257, 2, path)
    assert token_files.checksums(token_files.read(spark, path, order)).count() == 0


# language


def test_language(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcd" if i % 2 else "wxyz") + " " * (rng.random() < 0.2) for _ in range(rng.randint(20, 200)))) for i in range(60)]
    docs = documents(spark, rows).drop("lang").withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "one").when(F.col("doc_id") > 5, "two"))
    model = language.fit(docs.select("doc_id", "text", "lang"))
    found = language.predict(documents(spark, rows + edge_texts()).select("doc_id", "text", "source"), model)
    assert found.columns == ["doc_id", "text", "source", "lang_pred", "score"]
    for r in found.collect():
        lettered = bool(regex.search(r"\p{L}", r.text or ""))
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
        if r.text and set(r.text) <= set("abcd "):
            assert r.lang_pred == ("one" if lettered else "und")


def test_language_without_anything_to_learn_from(edge, nothing):
    model = language.fit(nothing)
    assert {(r.lang_pred, r.score) for r in language.predict(edge.select("doc_id", "text"), model).collect()} == {("und", 0.0)}
    assert language.predict(nothing.select("doc_id", "text"), model).count() == 0


# n-gram Jaccard join


def expected_components(rows, n, num, den):
    word = regex.compile(r"[^\x20\x09-\x0D]+")
    sets, parent = [], {}
    for i, t in rows:
        w = [x.encode().lower() for x in word.findall(t or "")]
        sets.append((i, frozenset([tuple(w[k : k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else []))))
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def found_components(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_jaccard_components_of_edges(edge):
    assert found_components(ngram_join.classes(edge, n=4, num=85)) == expected_components(edge_texts(), 4, 85, 100)


@pytest.mark.parametrize("pivots", [(1,), (1, 8), ()])
def test_jaccard_components_of_edited_copies(spark, pivots):
    rng = random.Random(4)
    base = [rng.choice(WORDS) + str(k) for k in range(60)]
    rows = []
    for i in range(70):
        words = list(base if i % 7 else base[:30] + [f"u{i}-{k}" for k in range(30)])
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 5)}"
        rows.append((1000 - i, " ".join(words)))
    found = ngram_join.classes(documents(spark, rows), n=2, num=80, pivots=pivots)
    assert found_components(found) == expected_components(rows, 2, 80, 100)


def test_jaccard_of_nothing(nothing):
    assert ngram_join.classes(nothing).count() == 0
    assert ngram_join.survivors(nothing).columns == nothing.columns


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(200 + k, 201 + k) for k in range(25)] + [(300, 300)]
    parent = {x: x for link in links for x in link if link[0] != link[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in found) == sorted((x, find(x)) for x in parent)


# quality


def test_quality(spark):
    rng = random.Random(3)
    good = [(i, sentence(rng, rng.randint(1, 80))) for i in range(150)]
    bad = [(i, " ".join(w + "$$$" for w in sentence(rng, rng.randint(5, 80)).split())) for i in range(150, 220)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 220, 2)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert model == model and sorted(r.doc_id for r in quality.accepted(docs, model).collect()) == list(range(150))
    assert quality.accepted(docs, model).columns == docs.columns
    scored = quality.score(documents(spark, edge_texts()).drop("score"), model)
    assert all(0 <= r.score <= 1 for r in scored.collect()) and scored.count() == len(edge_texts())


def test_quality_without_labels(spark, edge, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(edge.drop("score"), quality.fit(edge, labels)).collect()} == {0.5}
    ones = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    assert quality.accepted(edge, quality.fit(edge, ones)).count() == edge.count()
    assert quality.accepted(nothing, quality.fit(nothing, ones)).count() == 0


def test_dual_coordinate_descent_meets_its_optimum():
    """At the optimum the primal and the dual value of the hinge loss are equal."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(60)]
    values = [rng.normal(size=8) for _ in rows]
    signs = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    weights, intercept = quality.fit_hinge(rows, values, signs, np.ones(60), 3000)
    margins = np.array([weights[r] @ v + intercept for r, v in zip(rows, values)])
    norm = (weights**2).sum() + intercept**2
    primal = norm / 2 + np.maximum(0, 1 - signs * margins).sum()
    again = [quality.fit_hinge(rows, values, signs, np.ones(60), 3000, seed=s)[0] for s in (1, 2)]
    assert np.allclose(again[0], again[1], atol=1e-2) and primal < 60


def test_samples_are_bounded_and_fixed(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("long").alias("class"))
    first, second = features.sample_ids(rows, 50), features.sample_ids(rows.repartition(7), 50)
    assert first == second and {k: len(v) for k, v in first.items()} == {0: 50, 1: 50}


# licences


def test_licence_notices(spark):
    model = licenses.train(licenses.sample(documents(spark, edge_texts())))
    rows = edge_texts() + [
        (30, "some words\nReleased under the MIT License.\nmore words"),
        (31, "This work is licensed under the GNU General Public License, version 3"),
        (32, "LICENSED under the apache license, version 2.0.\r\n\nAll rights reserved."),
        (33, "Licensed under CC BY-NC 4.0."),
        (34, "The driver has a license. The MIT was there, the rights of all."),
        (35, "Released under the MIT License."),
        (35, "Released under the MIT License."),
    ]
    found = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.notices(documents(spark, rows), model).collect())
    wanted = [(30, 1, "MIT"), (31, 0, "GPL"), (32, 0, "Apache-2.0"), (32, 2, "reserved"), (33, 0, "CC-BY-NC"), (35, 0, "MIT"), (35, 0, "MIT")]
    assert found == wanted


def test_wrapped_licence_notices(spark):
    model = licenses.train(licenses.sample(documents(spark, edge_texts())))
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License"
    bsd = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met"
    isc = "// Permission to use, copy, modify, and/or distribute this software for any\r\n// purpose with or without fee is hereby granted"
    rows = edge_texts() + [
        (40, gpl),
        (41, "code here\n\n" + bsd + "\nmore words"),
        (42, "x\n\n\n" + isc),
        (43, "\n".join("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License".split())),
        (44, "All rights\n\nreserved."),
        (45, "All rights reserved.\nAll rights reserved."),
    ]
    found = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.notices(documents(spark, rows), model).collect())
    assert found == [(40, 0, "GPL"), (41, 2, "BSD"), (42, 3, "ISC"), (43, 0, "GPL"), (45, 0, "reserved"), (45, 1, "reserved")]


def test_licence_notices_of_one_line(spark):
    """Several notices of one line, and notices anywhere in very long lines."""
    rng = random.Random(3)
    model = licenses.train(licenses.sample(documents(spark, edge_texts())))
    mit, apache, gpl = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3"
    prose = [sentence(rng, 30000) for _ in range(3)]
    rows = edge_texts() + [
        (50, f"{mit} {apache}"),
        (51, f"{gpl}, and {apache.lower()} {mit}"),
        (52, f"{prose[0]} {mit} {prose[1]} {apache} {prose[2]} All rights reserved."),
        (53, f"a\n{mit} {mit}"),
    ]
    found = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.notices(documents(spark, rows), model).collect())
    wanted = [(50, 0, "Apache-2.0"), (50, 0, "MIT"), (51, 0, "Apache-2.0"), (51, 0, "GPL"), (51, 0, "MIT")]
    wanted += [(52, 0, "Apache-2.0"), (52, 0, "MIT"), (52, 0, "reserved"), (53, 1, "MIT"), (53, 1, "MIT")]
    assert found == wanted


def test_licence_sample_covers_long_lines(spark):
    line = " ".join(f"w{k}" for k in range(5000))
    found = licenses.sample(documents(spark, [(1, line)]))
    last = licenses._words(line)[-1]
    assert max(map(len, found)) <= licenses.SPAN_WORDS and any(last in words for words in found)


def test_licences_of_nothing(nothing):
    model = licenses.train(licenses.sample(nothing))
    assert licenses.notices(nothing, model).count() == 0


# web archives


def test_archives(spark, tmp_path):
    pages = [
        (5, "https://a.example/x?y=1#z", "<p>one WARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"),
        (3, "http://b.example", "<p>one WARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"),
        (9, None, None),
        (8, "https://c.example/\r\nEvil: header", ""),
        (7, "not an address", "ünïcode 😀"),
        (7, "not an address", "ünïcode 😀"),
        (11, "https://a.example/long", "x" * 200000),
    ]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, type string").repartition(3)
    path = str(tmp_path / "warc")
    warc.write(frame, path, pages_per_file=2)
    whole = warc.assemble(warc.read(spark, path))
    found = {r.page_id: r for r in warc.captures(whole).collect()}
    assert whole.count() == 6 and sorted(found) == [3, 5, 7, 8, 9, 11]
    for i, _, html in pages:
        data = (html or "").encode()
        assert found[i].payload_bytes == len(data)
        import base64

        assert found[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {i: (r.record_type, r.refers_to) for i, r in found.items()} == {
        3: ("response", None), 5: ("revisit", 3), 7: ("response", None), 8: ("response", None), 9: ("revisit", 8), 11: ("response", None)
    }
    row = {r.response.target_uri: r for r in whole.collect()}["https://a.example/x?y=1#z"]
    assert bytes(row.request.payload) == b"" and b"page-id: 5" in bytes(row.metadata.payload)


def test_archives_of_repeated_rows_and_null_pages(spark, tmp_path):
    pages = [(7, "u", "twin"), (7, "u", "twin"), (7, "u", "twin"), (8, "v", "twin"), (None, "w", "lone"), (None, None, "lone"), (None, None, "lone"), (None, "z", "twin"), (4, None, "x"), (4, "", "x"), (5, "y", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "warc")
    warc.write(frame, path, repeats=True)
    whole = warc.assemble(warc.read(spark, path))
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.captures(whole).collect())
    assert found == Counter({
        (7, 4, "response", None): 3, (8, 4, "revisit", 7): 1, (None, 4, "revisit", 7): 1, (None, 4, "response", None): 1,
        (None, 4, "revisit", None): 2, (4, 1, "response", None): 2, (5, 0, "response", None): 1,
    })


def test_warc_query_has_a_row_for_each_page(spark, tmp_path):
    import duckdb

    from quipu.llm.queries import ORACLE_SQL, QUERIES

    frame = spark.createDataFrame([(7, "u", "twin"), (7, "u", "twin"), (9, "v", "twin"), (3, None, None)], "page_id long, url string, html string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op8_warc"](spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    wanted = db.sql(ORACLE_SQL["op8_warc"]).fetchall()
    assert len(wanted) == 4 and sorted(map(tuple, found)) == sorted(wanted)


def test_small_payloads_are_not_revisited(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "v", "abcd")], "page_id long, url string, html string")
    warc.write(frame, str(tmp_path / "warc"), least_bytes=4)
    found = warc.captures(warc.assemble(warc.read(spark, str(tmp_path / "warc")))).collect()
    assert sorted((r.page_id, r.refers_to) for r in found) == [(1, None), (2, None), (3, None), (4, 3)]


def test_captures_without_their_side_records(spark):
    rows = [("response", "a", None, None, "u", "D", bytearray(b"x"), 1, "D"), ("request", "b", "zz", None, "u", None, bytearray(b""), 0, "E")]
    found = warc.assemble(spark.createDataFrame(rows, warc.RECORD_SCHEMA)).collect()
    assert len(found) == 1 and found[0].request is None and found[0].metadata is None


def test_archives_of_nothing(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(frame, str(tmp_path / "warc"))
    assert warc.captures(warc.assemble(warc.read(spark, str(tmp_path / "warc")))).count() == 0


NEIGHBOURS = [
    ("SPDX-License-Identifier: EPL-2.0", "EPL"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "LGPL"),
    ("SPDX-License-Identifier: GPL-2.0-only", "GPL"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("SPDX-License-Identifier: WTFPL", None),
    ("SPDX-License-Identifier: CDDL-1.0", None),
    ("Eclipse Public License 2.0", None),
    ("Released under the Eclipse Public License 2.0.", "EPL"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation", "LGPL"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published", "AGPL"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published", "GPL"),
    ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Not released under the MIT License.", None),
    ("It was never released under the MIT License.", None),
    ("Released under the MIT License.", "MIT"),
    ("Licensed under CC BY 4.0.", "CC-BY"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Zlib"),
]


def test_licences_are_told_from_their_neighbours(spark):
    rng = random.Random(4)
    rows = [(i, f"{sentence(rng, 12)}\n\n{text}\n\n{sentence(rng, 12)}") for i, (text, _) in enumerate(NEIGHBOURS)]
    model = licenses.train([licenses._words(sentence(rng, 20)) for _ in range(100)])
    found = {r.doc_id: r.family for r in licenses.notices(documents(spark, rows), model).collect()}
    assert {NEIGHBOURS[i][0]: found.get(i) for i in range(len(rows))} == dict(NEIGHBOURS)


# decontamination


@pytest.mark.parametrize("block_bytes", [1 << 24, 500])
def test_decontamination(spark, block_bytes):
    rng = random.Random(8)
    items = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 60)))) for k in range(12)] + [(50, None), (51, ""), (52, "two words!")]
    rows = edge_texts()

    def around(text):
        return " ".join(f"w{rng.randint(0, 400)}" for _ in range(50)) + " " + text + " " + sentence(rng, 20)

    wanted = set()
    for k, (item, text) in enumerate(items[:12]):
        words = text.split()
        edited = [w if rng.random() > 0.12 else "zz" for w in words]
        rows += [(100 + k, around(text.upper())), (200 + k, around(", ".join(edited))), (300 + k, around(" ".join(rng.sample(words, len(words)))))]
        wanted |= {(100 + k, item), (200 + k, item)}
    rows += [(400, "these two words, here"), (100, around(items[0][1]))]
    wanted.add((400, 52))
    bench = spark.createDataFrame([(*x, "clash") for x in items + items[:1]], "item_id long, text string, doc_id string")
    docs = documents(spark, rows)
    found = decontaminate.pairs(docs, bench, block_bytes=block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted and len(found) == len(wanted)
    if block_bytes > 500:
        left = decontaminate.clean(docs, bench)
        assert left.columns == docs.columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in rows if i not in {i for i, _ in wanted})


def edited(rng, words, rate):
    """Each word replaced, dropped, doubled by another or kept."""
    out = []
    for w in words:
        if rng.random() >= rate:
            out.append(w)
        else:
            out += rng.choice([[f"n{rng.randrange(900)}"], [], [w, f"n{rng.randrange(900)}"]])
    return out


def test_recall_against_full_alignment(spark):
    """All documents with all items, each aligned in full: at least nine in ten of what that accepts, and nothing else."""
    rng = random.Random(12)
    items = [(k, [f"w{rng.randrange(300)}" for _ in range(24)]) for k in range(8)]
    texts = []
    for k, words in items:
        for rate in (0.1, 0.2, 0.3, 0.35, 0.4, 0.45):
            texts += [edited(rng, words, rate) for _ in range(4)]
        for every in (1, 2, 3):
            texts.append([x for i, w in enumerate(words) for x in ([w, f"n{i}"] if i % every == every - 1 else [w])])
            texts.append([w for i, w in enumerate(words) if i % (every + 1) != every])
        texts.append(words[:13])
        texts.append(rng.sample(words, 24))
    filler = lambda: [f"w{rng.randrange(300)}" for _ in range(30)]
    rows = [(i, filler() + t + filler()) for i, t in enumerate(texts)] + [(1000 + i, filler() * 3) for i in range(60)]

    def codes(words):
        column = decontaminate.pa.array([" ".join(words)])
        return next(decontaminate._terms(column))[2]

    pairs = [(i, k) for i, _ in rows for k, _ in items]
    spelled, asked = {i: codes(t) for i, t in rows}, {k: codes(w) for k, w in items}
    scores = decontaminate.align([asked[k] for _, k in pairs], [spelled[i] for i, _ in pairs])
    full = {pair for pair, s in zip(pairs, scores.tolist()) if s / (decontaminate.MATCH * 24) >= decontaminate.LEAST_SCORE}
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.pairs(documents(spark, [(i, " ".join(t)) for i, t in rows]), bench).collect()}
    assert found <= full and len(full) > 150
    assert len(found) >= 0.98 * len(full), sorted(full - found)
    spaced = {i for i, t in enumerate(texts) if len(t) in (36, 48) and t[0].startswith("w")}
    assert len(spaced) >= 16 and spaced <= {i for i, _ in found}


def test_decontamination_of_nothing(spark, nothing, edge):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.pairs(nothing, bench).count() == 0
    assert decontaminate.pairs(edge, bench.where("false")).count() == 0
    assert len(CLASHING) + 4 == len(decontaminate.clean(edge, bench).columns)
