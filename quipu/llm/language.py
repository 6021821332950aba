"""Language of whole texts by string kernels.

The kernel of two texts is the blended spectrum of their n-gram presences: for one, two
and three bytes the number of common distinct n-grams, over the root of the product of
both numbers, weighted by n; upper and lower case count as one.  Nyström landmarks span the feature space, one ridge
regression per language against the rest gives linear scores, and texts are scored in
batches by matrix products.

Landmarks and training rows are bounded numbers per language; every row is scored on its
whole text.  A null text, and one without a letter, is ``und`` with score 0.  Without any
training row every text is ``und``.  Ties go to the language that sorts first.  Columns
beside the id, the text and the language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.llm import features

PER_LANGUAGE = 300
LANDMARKS = 24
WEIGHTS = (0.5, 1.0, 1.5)
RIDGE = 1e-2
BATCH = 128


@dataclass(frozen=True)
class Model:
    """Landmarks as columns of scaled presences, and the languages' scores by landmark."""

    languages: list[str]
    column: np.ndarray  # feature code -> row of the presence matrix, or -1
    landmarks: np.ndarray  # n-gram order x presence x landmark, scaled
    orders: np.ndarray  # n-gram order of each presence row
    scores: np.ndarray  # landmark x language

    def kernel(self, rows: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Kernel of texts with the landmarks: one matrix product per n-gram order."""
        here = np.zeros((len(rows), len(self.orders)), dtype=np.float32)
        sizes = np.ones((len(rows), len(WEIGHTS)), dtype=np.float32)
        for k, row in enumerate(rows):
            for n, codes in enumerate(row):
                places = self.column[codes]
                here[k, places[places >= 0]] = 1
                sizes[k, n] = max(len(codes), 1)
        total = np.zeros((len(rows), self.landmarks.shape[1]), dtype=np.float32)
        for n, weight in enumerate(WEIGHTS):
            part = self.orders == n
            total += weight * (here[:, part] @ self.landmarks[part]) / np.sqrt(sizes[:, n : n + 1])
        return total / sum(WEIGHTS)

    def predict(self, rows: list[tuple[np.ndarray, ...]]) -> tuple[list[str], np.ndarray]:
        """Best language and its share of the exponentials of the scores."""
        values = self.kernel(rows).astype(np.float64) @ self.scores
        odds = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
        best = values.argmax(axis=1)
        return [self.languages[b] for b in best], odds.max(axis=1) / odds.sum(axis=1)


def _by_order(codes: np.ndarray) -> tuple[np.ndarray, ...]:
    cuts = features.STARTS
    return tuple(codes[(codes >= a) & (codes < b)] for a, b in zip(cuts[:-1], cuts[1:]))


def fit_rows(rows: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Ridge regression on Nyström features of a bounded number of rows."""
    languages = sorted({lang for lang, _ in rows})
    chosen: list[np.ndarray] = []
    for lang in languages:
        own = sorted((codes for x, codes in rows if x == lang and len(codes)), key=lambda c: (-len(c), c.tobytes()))
        step = max(1, len(own) // landmarks)
        chosen += own[::step][:landmarks]
    if not chosen:
        empty = np.zeros((0, 0), dtype=np.float32)
        return Model([], np.zeros(features.WIDTH, dtype=np.int32), empty, np.zeros(0, dtype=np.int64), empty)
    used = np.unique(np.concatenate(chosen))
    used = used[used < features.STARTS[3]]
    column = np.full(features.WIDTH, -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    orders = np.searchsorted(features.STARTS, used, side="right") - 1
    matrix = np.zeros((len(used), len(chosen)), dtype=np.float32)
    for k, codes in enumerate(chosen):
        for part in _by_order(codes):
            matrix[column[part], k] = 1 / np.sqrt(max(len(part), 1))
    model = Model(languages, column, matrix, orders, np.zeros((len(chosen), len(languages))))
    inner = model.kernel([_by_order(codes) for codes in chosen]).astype(np.float64)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    good = value > 1e-6 * max(value.max(), 1e-12)
    root = vector[:, good] / np.sqrt(value[good])
    mapped = model.kernel([_by_order(codes) for _, codes in rows]).astype(np.float64) @ root
    mapped = np.concatenate([mapped, np.zeros((len(rows), 0))], axis=1)
    wanted = np.where(np.array([[x == lang for lang in languages] for x, _ in rows]), 1.0, -1.0)
    weight = np.array([1 / sum(y == x for y, _ in rows) for x, _ in rows])[:, None]
    gram = mapped.T @ (weight * mapped) + ridge * np.eye(mapped.shape[1])
    scores = root @ np.linalg.solve(gram, mapped.T @ (weight * wanted))
    return Model(languages, column, matrix, orders, scores)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from rows with a language; texts without a letter teach nothing."""
    known = docs.where(F.col(lang).isNotNull() & F.col(id).isNotNull())
    ids = known.select(F.col(id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("class"))
    chosen = features.sample_ids(ids, per_language)
    lettered = known.where(F.col(text).rlike(r"\p{L}"))
    # Rows that repeat a chosen id may have another language: each class reads its own rows.
    own = lettered.select(F.col(id), F.lower(text).alias(text), F.col(lang).cast("string").alias("_lang"))
    found = features.sample_features(own, chosen, text, id)
    return fit_rows(found)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_lettered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            column = column.fill_null("") if column.null_count else column
            langs, scores, held = [], [], []

            def flush() -> None:
                found, sure = model.predict(held)
                langs.extend(found)
                scores.extend(sure.tolist())
                held.clear()

            for t in features.texts(column):
                if model.languages:
                    held.append(features.presence(t))
                    if len(held) == BATCH:
                        flush()
                else:
                    langs.append("und")
                    scores.append(0.0)
            if held:
                flush()
            flags = batch.column(batch.num_columns - 2).to_pylist()
            langs = [x if f else "und" for x, f in zip(langs, flags)]
            scores = [x if f else 0.0 for x, f in zip(scores, flags)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-2], "lang_pred", "score"],
            )

    return docs.select("*", lettered, F.lower(text).alias("_folded")).mapInArrow(run, schema)
