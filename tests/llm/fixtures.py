"""Small tables with nulls, empty, long and repeated texts, and clashing column names."""

import random

from pyspark.sql import types as T

WORDS = "the of and stone river Über señor naïve 12 x9 don't we'll it's, end. 日本 😀 a".split()

#: Names that the operators use inside.
CLASHING = ["score", "row", "digest", "control", "batch", "rep", "block", "bucket", "ids", "size", "component", "_text", "_id", "lang_pred"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_texts(seed=5):
    rng = random.Random(seed)
    long = "\n".join(sentence(rng, 40) for _ in range(500))
    twin = sentence(rng, 60)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "word"),
        (5, twin),
        (6, twin),
        (6, twin),
        (7, twin + " more"),
        (8, long),
        (9, long + "\nand an end"),
        (10, "A" * 5000),
        (11, "nul \x00 and   separators \x85　here  ''s 'LL I'd"),
        (12, None),
        (13, ""),
        (14, "x" + twin),
        (15, sentence(rng, 3)),
        (16, "\n" * 300),
        (17, sentence(rng, 400)),
    ]


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in CLASHING]
)


def documents(spark, rows, partitions=3):
    """Rows of id and text as documents, with every clashing column filled or null."""
    full = [(i, t, "en", "src", *[None if k % 2 else "clash" for k in range(len(CLASHING))]) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)
