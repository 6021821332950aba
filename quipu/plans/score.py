"""Scoring of requests: check, encode, predict, label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.operators.encode import Dictionary, encode
from quipu.operators.models import label_scores, predict
from quipu.operators.validate import route
from quipu.schema import Table
from quipu.session import materialize
from quipu.sources.requests import CORRUPT, parse_requests


BODY = "_body"


@dataclass(frozen=True)
class Scored:
    """Replies to the good requests, and the bad ones with their reasons."""

    accepted: DataFrame
    quarantined: DataFrame


def check_requests(df: DataFrame, body: str, spec: Table, dictionary: Dictionary, keep: list[str]) -> DataFrame:
    """Parsed, checked and encoded requests: ``keep``, the body, codes, ``valid`` and the reasons."""
    kept = df.withColumn(BODY, F.col(body))
    checked = route(parse_requests(kept, body, spec, [*keep, BODY]), spec)
    coded = encode(checked, dictionary, spec.text_features, unseen="quarantine")
    return coded.withColumn("valid", F.col("valid") & (F.size("unseen") == 0))


def outcomes(
    df: DataFrame, body: str, spec: Table, dictionary: Dictionary, model: PipelineModel, keep: list[str]
) -> DataFrame:
    """Every request with its reply, or with the reasons and its body, in one pass.

    The model sees zeros in place of the features of a bad request; its answer to
    them is dropped.
    """
    checked = check_requests(df, body, spec, dictionary, keep)
    ready = checked.withColumns({c: F.when(F.col("valid"), F.col(c)).otherwise(F.lit(0)) for c in spec.features})
    replied = label_scores(predict(ready, model))
    good, bad = F.col("valid"), ~F.col("valid")
    return replied.select(
        *keep,
        "valid",
        F.when(good, F.col("int_output")).alias("int_output"),
        F.when(good, F.col("str_output")).alias("str_output"),
        *[F.when(bad, F.col(c)).alias(c) for c in ("missing", "violations", "unseen")],
        F.col(CORRUPT).alias("corrupt"),
        F.when(bad, F.col(BODY)).alias("body"),
    )


def split_outcomes(found: DataFrame, keep: list[str]) -> Scored:
    """Replies, and quarantine with the bodies, of a stored table of outcomes."""
    replies = found.filter("valid").select(*keep, "int_output", "str_output")
    bad = found.filter("NOT valid").select(*keep, "missing", "violations", "unseen", "corrupt", "body")
    return Scored(replies, bad)


def score_requests(
    df: DataFrame, body: str, spec: Table, dictionary: Dictionary, model: PipelineModel, keep: list[str]
) -> Scored:
    """Score a table of request texts.

    The outcome is written once, by validity; replies and quarantine each read only
    their own rows of it.
    """
    found = outcomes(df, body, spec, dictionary, model, keep)
    return split_outcomes(materialize(found, "outcomes", ["valid"]), keep)
