"""Licence notices in whole texts: stretches that follow a template, and a trained classifier.

A paragraph is a run of adjacent lines that have words, so a notice may be wrapped.  In
every paragraph, whatever its length, each stretch of words that has enough of a
template's word pairs in order, within a reach that follows from the template's length,
is a candidate.  Its features are the distinct one- to three-word sequences that occur in
the templates; a sparse logistic regression (L1, one output per family and one for
"unknown") is trained on varied templates and on short spans of a bounded sample of the
corpus.  A temperature fitted on rows that were kept out calibrates the probabilities.  A
candidate stands if its template's family is the likeliest for its words, if it holds the
words that name the template's licence and no other's, and if no denial stands just before
it; so neighbours (LGPL and GPL, other versions, unlisted SPDX names) stay apart or unknown.  Of candidates
that share words the one with the most pairs, less half of those missed or skipped, is
reported, with the line on which it begins; so a line or paragraph may have many notices.

Null and empty texts have no paragraph to report.  Repeated rows are reported row by row,
ties go to the family that sorts first, and an empty corpus gives an empty result (the
model then learns from templates alone).  Columns beside the id and the text are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import features, scan

UNKNOWN = "unknown"
SAMPLE_DOCUMENTS = 300
SAMPLE_PARAGRAPHS = 4000
LEAST_SIMILARITY = 0.6
SPAN_WORDS = 64
LONGEST = 3
# A notice lies within so many words for each of its template's pairs, and so many more.
REACH, REACH_MORE = 2, 16

# Usual wording of licence notices, by family.
TEMPLATES: dict[str, list[str]] = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Released under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL": [
        "GNU General Public License Version 3",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Released under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
    ],
}

# Words that name a licence.  A stretch must hold those of its template, and no others.
NAMING = (
    "affero agpl apache attribution bsd by creative eclipse epl gnu gpl isc lesser lgpl mit mozilla mpl nc "
    "noncommercial unencumbered unlicense zlib"
).split()
# Families of one version, and the words that tell it.
VERSIONS = {"Apache-2.0": ["2", "0"]}
# Words that, just before a stretch, say the opposite.
DENIALS = "not never isn aren neither nor".split()
DENIAL_REACH = 2

# Paragraphs that use such words for something else.
OTHERWISE = [
    "She renewed her driving license last week.",
    "The restaurant lost its liquor license, version of events disputed.",
    "The MIT researchers released a new paper under the title of the conference.",
    "A table was reserved for all of us.",
    "The rights of all citizens are protected.",
    "General public opinion has shifted this year.",
    "The Apache helicopter landed at noon.",
    "Free of charge, any person may enter the museum.",
    "It was released under pressure.",
    "This work is done, and the program is over.",
]


@dataclass(frozen=True)
class Model:
    """Word sequences in ascending order of hash, their weights by family, and templates."""

    families: list[str]  # the last is "unknown"
    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    sift: np.ndarray
    templates: list[list[np.ndarray]]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.flatnonzero(self.sift[(hashes >> np.uint64(44)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.grams, hashes[near]), len(self.grams) - 1)
        same = self.grams[number] == hashes[near]
        return near[same], number[same]

    def paragraphs(self, hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs with any known word sequence, and the probabilities of all families."""
        width = len(self.grams) + 1
        found = []
        for n in range(1, LONGEST + 1):
            grams, starts = scan.ngram_hashes(hashes, begins, n)
            place, number = self.find(grams)
            found.append((np.searchsorted(starts, place, side="right") - 1) * width + number)
        pairs = np.unique(np.concatenate(found))
        paragraph, number = pairs // width, pairs % width
        some, begin = np.unique(paragraph, return_index=True)
        if not len(some):
            return some, np.zeros((0, len(self.families)))
        return some, _softmax(np.add.reduceat(self.weights[number], begin, axis=0) + self.bias)

    def candidates(self, hashes: np.ndarray, begins: np.ndarray, least: float) -> list[tuple[float, int, int, int, float]]:
        """Score, first word, word after the last, family and share of pairs of each stretch that has enough of a template."""
        grams, starts = scan.ngram_hashes(hashes, begins, 2)
        known = np.unique(np.concatenate([_pairs(t) for own in self.templates for t in own]))
        number = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        place = np.flatnonzero(known[number] == grams)
        number = number[place]
        paragraph = np.searchsorted(starts, place, side="right") - 1
        word = begins[paragraph] + place - starts[paragraph]
        found = []
        for family, own in enumerate(self.templates):
            for template in own:
                pairs = np.searchsorted(known, _pairs(template))
                part = np.zeros(len(known), dtype=bool)
                part[pairs] = True
                hits = np.flatnonzero(part[number])
                enough, reach = int(np.ceil(least * len(pairs) - 1e-9)), REACH * len(pairs) + REACH_MORE
                ahead = hits[enough - 1 :]
                behind = hits[: len(ahead)]
                close = np.flatnonzero((word[ahead] - word[behind] <= reach) & (paragraph[ahead] == paragraph[behind]))
                if not len(close):
                    continue
                told, others, denials = _telling(self.families[family], template)
                where: dict[int, list[int]] = {}
                for k in range(len(pairs) - 1, -1, -1):
                    where.setdefault(int(pairs[k]), []).append(k)
                ends = np.minimum(np.searchsorted(word[hits], word[hits[close]] + reach, side="right"), np.searchsorted(paragraph[hits], paragraph[hits[close]], side="right"))
                for a, b in zip(close.tolist(), ends.tolist()):
                    first = int(word[hits[a]])
                    if np.isin(hashes[max(first - DENIAL_REACH, int(begins[paragraph[hits[a]]])) : first], denials).any():
                        continue
                    for n, last in _common_in_order(where, number[hits[a:b]].tolist(), word[hits[a:b]].tolist(), enough):
                        own_words = hashes[first : last + 2]
                        if not np.isin(told, own_words).all() or np.isin(others, own_words).any():
                            continue
                        score = n - (last - first + 1 - n) / 2 - (len(pairs) - n) / 2
                        found.append((score, first, last + 2, family, n / len(pairs)))
        return found

    def confirmed(self, hashes: np.ndarray, begins: np.ndarray, least: float) -> list[tuple[int, int, float, float]]:
        """First word, family, probability and share of pairs of the notices, none of which share a word."""
        found = self.candidates(hashes, begins, least)
        if not found:
            return []
        spans, of = np.unique(np.array([f[1:3] for f in found]), axis=0, return_inverse=True)
        size = spans[:, 1] - spans[:, 0]
        some, odds = self.paragraphs(hashes[scan.ragged(spans[:, 0], size)], np.concatenate([[0], np.cumsum(size)]))
        at = dict(zip(some.tolist(), range(len(some))))
        best = odds.argmax(axis=1)
        taken = np.zeros(len(hashes), dtype=bool)
        out = []
        for (_, first, end, family, alike), span in sorted(zip(found, of.ravel().tolist()), key=lambda f: (-f[0][0], f[0][1:])):
            k = at.get(span)
            if k is not None and best[k] == family and not taken[first:end].any():
                taken[first:end] = True
                out.append((first, family, float(odds[k, family]), alike))
        return sorted(out)


def _telling(family: str, template: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that a stretch of the template must hold, words it must not hold, and words that deny what follows."""
    naming = _words(" ".join(NAMING))
    held = np.isin(naming, template)
    versions = _words(" ".join(VERSIONS.get(family, [])))
    return np.concatenate([naming[held], versions[np.isin(versions, template)]]), naming[~held], _words(" ".join(DENIALS))


def _pairs(words: np.ndarray) -> np.ndarray:
    return scan.ngram_hashes(words, np.array([0, len(words)]), 2)[0]


def _common_in_order(where: dict[int, list[int]], pairs: list[int], words: list[int], enough: int) -> Iterator[tuple[int, int]]:
    """Length of the longest common subsequence with a template, and the word, wherever it grows to ``enough`` or more.

    ``where`` holds the places of a pair in the template, the last first.
    """
    tails: list[int] = []
    for pair, word in zip(pairs, words):
        before = len(tails)
        for k in where[pair]:
            at = bisect_left(tails, k)
            tails[at : at + 1] = [k]
        if len(tails) > before and len(tails) >= enough:
            yield len(tails), word


def _softmax(values: np.ndarray) -> np.ndarray:
    odds = np.exp(values - values.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _lines(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Borders of the lines of all texts."""
    return np.unique(np.concatenate([borders, np.flatnonzero(data == 0x0A) + 1]))


def _line_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First row of the slice, word hashes, where each line begins, its row and its number there."""
    for a, _, data, borders in scan.slices(column):
        lines = _lines(data, borders)
        start, _, hashes, _ = scan.word_hashes(data, lines, inside=scan.IN_TERM)
        row = np.searchsorted(borders, lines[:-1], side="right") - 1
        number = np.arange(len(row)) - np.searchsorted(row, row)
        yield a, hashes, np.searchsorted(start, lines), row, number


def _paragraphs(lines: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where the words of each run of lines with words begin, and the end of all."""
    filled = np.diff(lines) > 0
    follows = np.zeros(len(row), dtype=bool)
    follows[1:] = filled[:-1] & (row[1:] == row[:-1])
    return np.append(lines[:-1][filled & ~follows], lines[-1])


def _spans(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the spans of at most ``SPAN_WORDS`` words of all lines begin, and the line of each."""
    count = -(-np.diff(lines) // SPAN_WORDS)
    line = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
    return np.append(lines[line] + inner * SPAN_WORDS, lines[-1]), line


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return scan.word_hashes(data, np.array([0, len(data)]), inside=scan.IN_TERM)[2]


def _grams(words: np.ndarray) -> np.ndarray:
    begins = np.array([0, len(words)])
    return np.unique(np.concatenate([scan.ngram_hashes(words, begins, n)[0] for n in range(1, LONGEST + 1)]))


def train(others: list[np.ndarray], seed: int = 11, variants: int = 12, rounds: int = 150, sparsity: float = 2e-4) -> Model:
    """Fit on varied templates against other paragraphs, given as word hashes."""
    rng = np.random.default_rng(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    templates = [[_words(t) for t in TEMPLATES[f]] for f in families[:-1]]
    grams = np.unique(np.concatenate([_grams(t) for own in templates for t in own]))
    around = [w for w in others if len(w)] or [_words(t) for t in OTHERWISE]
    spelled = [_grams(t) for own in templates for t in own]
    clear = [o for o in others if len(o) and not _holds_template(o, spelled)]
    rows, wanted = [], []
    for k, own in enumerate(templates):
        for template in own:
            rows.append(template)
            wanted.append(k)
            for _ in range(variants):
                kept = template[rng.random(len(template)) > 0.1]
                before, after = (around[rng.integers(len(around))][: rng.integers(0, 12)] for _ in range(2))
                rows.append(np.concatenate([before, kept, after]) if len(kept) else template)
                wanted.append(k)
    for other in [*clear, *[_words(t) for t in OTHERWISE for _ in range(5)]]:
        rows.append(other)
        wanted.append(len(families) - 1)
    x = np.zeros((len(rows), len(grams)))
    for k, words in enumerate(rows):
        own = _grams(words)
        place = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        x[k, place[grams[place] == own]] = 1
    # Equal rows, above all paragraphs without any known sequence, count together.
    wanted = np.array(wanted)
    x, index, counts = np.unique(np.column_stack([x, wanted]), axis=0, return_inverse=True, return_counts=True)
    wanted, x = x[:, -1].astype(int), x[:, :-1]
    weight = np.sqrt(counts) / np.bincount(wanted, weights=np.sqrt(counts), minlength=len(families))[wanted]
    y = np.eye(len(families))[wanted]
    apart = rng.random(len(x)) < 0.2

    def fit(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights, bias = np.zeros((x.shape[1], len(families))), np.zeros(len(families))
        ahead, momentum = weights, 1.0
        own = weight[part][:, None] / weight[part].sum()
        step = 4.0 / max(1.0, float((own * (x[part] ** 2).sum(axis=1, keepdims=True)).sum()))
        for _ in range(rounds):
            error = own * (_softmax(x[part] @ ahead + bias) - y[part])
            new = ahead - step * (x[part].T @ error)
            new = np.sign(new) * np.maximum(np.abs(new) - step * sparsity, 0)
            bias = bias - step * error.sum(axis=0)
            following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead = new + (momentum - 1) / following * (new - weights)
            weights, momentum = new, following
        return weights, bias

    weights, bias = fit(~apart)
    values = x[apart] @ weights + bias
    best, scale = np.inf, 1.0
    for t in np.geomspace(0.5, 8, 25):
        loss = -(weight[apart] * np.log(_softmax(values * t)[np.arange(apart.sum()), wanted[apart]] + 1e-12)).sum()
        if loss < best:
            best, scale = loss, t
    weights, bias = fit(np.ones(len(x), dtype=bool))
    used = np.flatnonzero(np.abs(weights).sum(axis=1) > 0)
    sift = np.zeros(1 << 20, dtype=bool)
    sift[(grams[used] >> np.uint64(44)).astype(np.int64)] = True
    return Model(families, grams[used], (weights[used] * scale).astype(np.float32), (bias * scale).astype(np.float32), sift, templates)


def _holds_template(words: np.ndarray, templates: list[np.ndarray]) -> bool:
    """Whether half of a template's word sequences occur, so that the paragraph may be a notice."""
    own = _grams(words)
    return any(np.isin(t, own).mean() >= 0.5 for t in templates)


def sample(docs: DataFrame, text: str = "text", id: str = "doc_id", documents: int = SAMPLE_DOCUMENTS, paragraphs: int = SAMPLE_PARAGRAPHS) -> list[np.ndarray]:
    """Word hashes of spans of lines to learn from: a bounded number, of a bounded number of documents.

    Long lines are cut into spans that cover all of them, and the spans are drawn evenly.
    """
    ids = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("class"))
    chosen = [(i,) for own in features.sample_ids(ids, documents).values() for i in own]
    if not chosen:
        return []
    known = docs.sparkSession.createDataFrame(pa.table({"_id": pa.array([c[0] for c in chosen], pa.int64())}))
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(known), "_id")
    per_document = max(1, paragraphs // documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, hashes, lines, row, _ in _line_words(batch.column(1)):
                begins, line = _spans(lines)
                row = row[line]
                for own in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1):
                    spread = own[np.unique(np.linspace(0, len(own) - 1, per_document).round().astype(int))] if len(own) else own
                    found += [hashes[begins[k] : begins[k + 1]].astype("<u8").tobytes() for k in spread]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["words"])

    return [np.frombuffer(w, dtype="<u8") for w in sorted(bytes(r[0]) for r in rows.select("_id", "_text").mapInArrow(run, "words binary").collect())]


def notices(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id", least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """``doc_id``, ``paragraph``, ``family``, ``probability``, ``similarity`` of each confirmed notice.

    ``paragraph`` is the number, from 0, of the line on which the notice begins.
    """
    names = ["doc_id", "paragraph", "family", "probability", "similarity"]
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = []
            for a, hashes, lines, row, number in _line_words(batch.column(1)):
                for first, family, odds, alike in model.confirmed(hashes, _paragraphs(lines, row), least_similarity):
                    k = np.searchsorted(lines, first, side="right") - 1
                    found.append((ids[a + row[k]], int(number[k]), model.families[family], odds, alike))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) if n != "doc_id" else pa.array(c, pa.int64()) for n, c in zip(names, zip(*found))], names=names)

    return rows.mapInArrow(run, "doc_id long, paragraph long, family string, probability double, similarity double")
