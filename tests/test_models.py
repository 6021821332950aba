"""Trees whose small nodes are not split."""

import random

import pytest
from pyspark.sql import functions as F

from quipu.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    made = [(rng.randrange(20), rng.randrange(15), rng.randrange(9)) for _ in range(900)]
    return spark.createDataFrame([(a, b, c, int((a * 3 + b * c) % 7 > 3)) for a, b, c in made], "a int, b int, c int, y int").cache()


FEATURES = ["a", "b", "c"]


def grow(rows, depth, limit, least):
    """A tree over whole numbers, grown from the root: rows are (features, class)."""
    ones = sum(y for _, y in rows)
    leaf = float(ones * 2 > len(rows))
    if depth == 0 or len(rows) < limit or ones in (0, len(rows)):
        return leaf
    gini = lambda part: len(part) - sum(y for _, y in part) ** 2 / len(part) - (len(part) - sum(y for _, y in part)) ** 2 / len(part)
    best = None
    for f in range(3):
        for cut in sorted({x[f] for x, _ in rows})[:-1]:
            left, right = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
            if min(len(left), len(right)) >= least:
                found = (gini(left) + gini(right), f, cut, left, right)
                best = found if best is None or found[0] < best[0] - 1e-9 else best
    if best is None or best[0] >= gini(rows) - 1e-9:
        return leaf
    _, f, cut, left, right = best
    return f, cut, grow(left, depth - 1, limit, least), grow(right, depth - 1, limit, least)


def call(tree, x):
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if x[f] <= cut else right
    return tree


@pytest.mark.parametrize("limit", [40, 150, 10_000])
def test_predictions_of_a_hand_grown_tree(spark, rows, limit):
    model = models.fit(rows, models.tree_classifier("y", 5, maxBins=32, minInstancesPerNode=2), FEATURES, limit)
    told = [((r.a, r.b, r.c), r.y) for r in rows.collect()]
    tree = grow(told, 5, limit, 2)
    found = models.predict(rows, model).collect()
    differing = sum(call(tree, (r.a, r.b, r.c)) != r.prediction for r in found)
    assert differing <= 0.02 * len(found)  # equal gains may be told apart otherwise
    nodes = models.tree_nodes(spark, model)
    assert nodes.where(f"leftChild >= 0 AND rawCount < {limit}").isEmpty()
    assert limit < 10_000 or nodes.count() == 1


def test_no_inner_node_of_a_forest_is_below_the_limit(spark, rows):
    forest = models.forest_classifier("y", numTrees=4, maxDepth=8)
    whole, cut = models.fit(rows, forest, FEATURES), models.fit(rows, forest, FEATURES, 60)
    full, kept = models.tree_nodes(spark, whole), models.tree_nodes(spark, cut)
    small = "leftChild >= 0 AND rawCount < 60"
    assert not full.where(small).isEmpty() and kept.where(small).isEmpty()
    # What may be split is as before: the same number of splits on the same features, in every tree.
    for t in range(4):
        of = lambda df: sorted((r.rawCount, r.split.featureIndex, tuple(r.split.leftCategoriesOrThreshold)) for r in df.where(f"treeID = {t} AND leftChild >= 0 AND rawCount >= 60").collect())
        assert of(full) == of(kept)
        ids = sorted(r.id for r in kept.where(f"treeID = {t}").collect())
        assert ids == list(range(len(ids)))
    assert whole.stages[-1].totalNumNodes > cut.stages[-1].totalNumNodes
    # A row's prediction is that of the node where it would have been split.
    assert models.predict(rows, cut).where("prediction = y").count() > 0.5 * rows.count()


def test_collapsed_model_is_saved_and_loaded(spark, rows, tmp_path):
    cut = models.fit(rows, models.small_forest("y", 6, 3), FEATURES, 100)
    models.save_model(cut, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    both = models.predict(models.predict(rows, cut, "one"), again, "two")
    assert both.where(F.col("one") != F.col("two")).isEmpty()


def test_a_limit_of_two_changes_nothing(spark, rows):
    forest = models.forest_classifier("y", numTrees=3, maxDepth=5)
    one, two = models.fit(rows, forest, FEATURES), models.fit(rows, forest, FEATURES, 2)
    both = models.predict(models.predict(rows, one, "one"), two, "two")
    assert both.where(F.col("one") != F.col("two")).isEmpty()
    assert one.stages[-1].totalNumNodes == two.stages[-1].totalNumNodes
