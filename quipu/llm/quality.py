"""Quality of whole texts by naive-Bayes support vectors.

A text is the set of its n-grams: one to three bytes, and eight words each told apart only
as "the one before again" or "another".  Each indicator is scaled by the smoothed log
ratio of its counts in the two classes, rows are brought to unit length together with a
constant share that a typical text has (so that a few words say little), and a linear hinge-loss model is fitted by dual coordinate descent.  Margins become
scores by a sigmoid fitted on margins of rows that the model did not see.

The model is fitted on at most ``per_class`` labelled rows of each class, those with the
smallest hashes of their ids; every row is scored on its whole text.  Null and empty texts
are scored by the model's intercept.  Rows without a label, or with a null one, are not
learnt from; an id with both labels counts for both.  With labels of one class only, or
none, every score is that class's share, or a half.  Columns beside the id, the text and
the label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.llm import features, scan

PER_CLASS = 2000
EPOCHS = 12


@dataclass(frozen=True)
class Model:
    """Log-count ratios and weights by feature, intercept, and the sigmoid's two numbers."""

    ratios: np.ndarray
    weights: np.ndarray
    intercept: float
    mass: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, codes: np.ndarray) -> float:
        norm = float(np.sqrt((self.ratios[codes] ** 2).sum() + self.mass)) or 1.0
        return float((self.weights[codes] * self.ratios[codes]).sum()) / norm + self.intercept

    def score(self, codes: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(codes) + self.offset, -35, 35))))


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log of each indicator's share in the positive class over that in the other."""
    counts = np.full((2, features.WIDTH), smoothing)
    for codes, good in zip(rows, positive):
        counts[int(good), codes] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def fit_hinge(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray, epochs: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; the intercept is one more constant feature."""
    weights, intercept = np.zeros(features.WIDTH), 0.0
    dual = np.zeros(len(rows))
    squares = np.array([float((v**2).sum()) + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (float(weights[rows[i]] @ values[i]) + intercept) - 1
            new = min(max(dual[i] - gradient / squares[i], 0.0), cost[i])
            step = (new - dual[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                intercept += step
                dual[i] = new
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return weights, intercept


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the class probability; rows weigh as their classes do among all labels."""
    good = positive.sum()
    weight = np.where(positive, share / max(good, 1), (1 - share) / max(len(positive) - good, 1)) * len(positive)
    target = np.where(positive, (good + 1) / (good + 2), 1 / (len(positive) - good + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit_rows(rows: list[np.ndarray], positive: np.ndarray, share: float, cost: float = 1.0, epochs: int = EPOCHS) -> Model:
    """The model of a bounded number of rows."""
    zero = np.zeros(features.WIDTH)
    if positive.all() or not positive.any():
        p = min(max(share, 1e-6), 1 - 1e-6) if len(rows) else 0.5
        return Model(zero, zero, 0.0, 1.0, 1.0, float(np.log(p / (1 - p))))

    def once(part: np.ndarray) -> Model:
        own = [rows[i] for i in part]
        ratios = log_count_ratios(own, positive[part])
        squares = np.array([(ratios[codes] ** 2).sum() for codes in own])
        mass = float(np.median(squares))
        values = [ratios[codes] / (np.sqrt(s + mass) or 1.0) for codes, s in zip(own, squares)]
        share = positive[part].mean()
        balance = np.where(positive[part], 1 / share, 1 / (1 - share)) / 2
        signs = np.where(positive[part], 1.0, -1.0)
        return Model(ratios, *fit_hinge(own, values, signs, cost * balance, epochs), mass)

    half = np.arange(len(rows)) % 2
    margins = np.zeros(len(rows))
    for k in (0, 1):
        part = np.flatnonzero(half != k)
        if positive[part].all() or not positive[part].any():
            part = np.arange(len(rows))
        model = once(part)
        for i in np.flatnonzero(half == k):
            margins[i] = model.margin(rows[i])
    slope, offset = fit_sigmoid(margins, positive, share)
    return replace(once(np.arange(len(rows))), slope=slope, offset=offset)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learn from the labelled rows that ``labels`` names; 1 is the positive label."""
    rows = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    rows = rows.select(F.col(id).cast("long").alias("doc_id"), (F.col(label) == 1).cast("long").alias("class")).distinct()
    counts = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = features.sample_ids(rows, per_class)
    # An id with both labels stands once for each.
    found = [(c, codes) for c in chosen for _, codes in features.sample_features(docs, {c: chosen[c]}, text, id)]
    found.sort(key=lambda r: (len(r[1]), r[1].tobytes()))
    positive = np.array([c == 1 for c, _ in found], dtype=bool)
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return fit_rows([codes for _, codes in found], positive, share)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of each row's whole text, and keep all columns."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            column = column.fill_null("") if column.null_count else column
            scores = [model.score(codes) for codes in features.indicators(column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])
            del batch, column
            scan.release()

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose whole text scores at least ``least``, with all their columns."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(codes) >= least for codes in features.indicators(batch.column(0).field(place))]
            yield batch.filter(pa.array(keep, pa.bool_()))
            del batch
            scan.release()

    return rows.mapInArrow(run, rows.schema).select("row.*")
