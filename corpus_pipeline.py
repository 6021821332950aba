"""From raw documents to token ids: five stages, each on all that the one before kept.

Documents that the quality classifier rejects go; of equal texts, and of each group of
similar ones (five-word shingles, Jaccard similarity of 0.8 or more), one document stays;
documents with a benchmark passage go; what is left is encoded, decoded and checked.

A null text counts as empty: such documents equal each other, and are similar to none.  A row
without an id cannot be named by a pair or a label; it stays unless the classifier rejects
it or its text has a row with an id.  Rows that repeat an id and text stay together; of
equal texts under different ids the largest stays, of similar ones the smallest.  Texts
are taken whole, however long.  All other columns pass through all stages but the last.  An
empty table gives an empty result of each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from quipu.llm.queries import MULTILINGUAL
from quipu.llm.tables import table
from quipu.session import new_path

SHINGLE_WORDS = 5
SIMILARITY = (80, 100)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a classifier, learnt from the labelled ones, does not reject."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.survivors(docs)


def dissimilar_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id."""
    num, den = SIMILARITY
    return ngram_join.survivors(docs, n=SHINGLE_WORDS, num=num, den=den)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of a test item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they stand for its text."""
    encoded = bpe.encode(docs, MULTILINGUAL)
    return bpe.decode(encoded, MULTILINGUAL).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", dissimilar_texts),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The classifier has no form in SQL; the stages are tested against brute force.
ORACLE_SQL = None
