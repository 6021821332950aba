"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.session import materialize


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node either points at one root or is one."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    roles = roles.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    per_node = roles.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per_node.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it reaches, for each node of a link.

    ``links`` has ``a`` and ``b`` (long).  Each round is a few joins whose inputs are
    written to the shared folder; neighbours of a node are never gathered.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
