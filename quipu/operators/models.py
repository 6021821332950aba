"""Distributed estimators with the parameters this work uses, and their fit."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.functions.numbers import MAX_DEPTH
from quipu.operators import binned
from quipu.operators.nodes import flat, rewritten
from quipu.schema import NEGATIVE_LABEL, POSITIVE_LABEL
from quipu.session import ensure_checkpoint_dir, new_path

VECTOR = "_features"

# Fixed value: nodes of fewer rows are not split in the production forest.
MIN_SAMPLES_SPLIT = 10

# What a fit keeps of one part of its rows.
PART_BYTES = 64 << 20

# So many bytes of mapped rows are exchanged before a fit; larger tables are only before they are mapped.
MAPPED_BYTES = 1 << 30

TREES = (DecisionTreeClassifier, RandomForestClassifier, RandomForestRegressor)


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """The features as one vector, in the given order; a null stops the job."""
    return _assembler(features).transform(df)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=VECTOR, handleInvalid="error")


def forest_classifier(label: str, **params) -> RandomForestClassifier:
    """The production forest.

    Codes are plain numbers, not nominal attributes, so a column may have more
    values than ``maxBins``.  Node ids are kept from level to level and checkpointed,
    which keeps the lineage short.
    """
    defaults = dict(
        numTrees=100,
        maxDepth=10,
        minInstancesPerNode=2,
        featureSubsetStrategy="sqrt",
        bootstrap=False,
        seed=42,
        cacheNodeIds=True,
    )
    return RandomForestClassifier(featuresCol=VECTOR, labelCol=label, **{**defaults, **params})


def _depth(wanted: int) -> int:
    if not 0 <= wanted <= MAX_DEPTH:
        raise ValueError(f"trees grow to depth {MAX_DEPTH}, not {wanted}")
    return wanted


def tree_classifier(label: str, max_depth: int, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol=VECTOR, labelCol=label, maxDepth=_depth(max_depth), **{"seed": 42, "cacheNodeIds": True, **params}
    )


def small_forest(label: str, max_depth: int, trees: int, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        maxDepth=_depth(max_depth),
        numTrees=trees,
        **{"featureSubsetStrategy": "sqrt", "seed": 42, "cacheNodeIds": True, **params},
    )


def linear_svm(label: str, c: float, rows: int, **params) -> LinearSVC:
    """A linear support-vector classifier with penalty ``c``.

    Spark averages the hinge loss over the rows where the penalty form sums it,
    so ``1 / (rows * c)`` is the same trade-off.  Every step of the solver reads
    the table, and weakly penalized fits take many.  ``maxIter`` bounds them; whether a
    fit ended before that bound is what :func:`converged` tells.
    """
    defaults = dict(regParam=1.0 / (rows * c), standardization=False, maxIter=100, tol=1e-3)
    return LinearSVC(labelCol=label, **{"featuresCol": VECTOR, **defaults, **params})


def converged(model: PipelineModel) -> bool:
    """Whether the solver of a support-vector model stopped by itself."""
    fitted = model.stages[-1]
    return fitted.summary().totalIterations < fitted.getMaxIter()


def forest_regressor(label: str, **params) -> RandomForestRegressor:
    defaults = dict(numTrees=100, maxDepth=6, featureSubsetStrategy="3", seed=42)
    return RandomForestRegressor(featuresCol=VECTOR, labelCol=label, **{**defaults, **params})


def row_bytes(estimator: Estimator | list[Estimator | Transformer], features: list[str]) -> int:
    """About how much a fit keeps of a row: all mapped features, or bins, and of each tree a draw and two node numbers."""
    stages = estimator if isinstance(estimator, list) else [estimator]
    if isinstance(stages[-1], TREES):
        return 200 + 4 * len(features) + 12 * (stages[-1].getNumTrees() if stages[-1].hasParam("numTrees") else 1)
    mapping = stages[-2] if len(stages) > 1 else None
    if isinstance(mapping, ElementwiseProduct):
        return 8 * len(mapping.getScalingVec())
    return 8 * len(mapping.getInputCols() if isinstance(mapping, VectorAssembler) else features)


def spread(df: DataFrame, width: int) -> DataFrame:
    """The rows dealt to so many parts that what a fit keeps of one is bounded; a small table stays as it is.

    Files hold rows in little room, and a part that is read from them may keep a hundred times their size.
    """
    parts = -(-df.count() * width // PART_BYTES)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else df


def fit(
    df: DataFrame, estimator: Estimator | list[Estimator | Transformer], features: list[str], min_samples_split: int | None = None
) -> PipelineModel:
    """Fit an estimator, behind the steps before it if it is a list, on the features.

    Trees on many rows and few features learn from counts of binned rows, see :mod:`quipu.operators.binned`.
    With ``min_samples_split`` tree nodes of fewer rows are not split, see :func:`collapse_small_nodes`.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stages = estimator if isinstance(estimator, list) else [estimator]
    model = binned.fit(df, _assembler(features), estimator, features) if isinstance(estimator, TREES) else None
    if model is None:
        rows, (*mapping, last) = df.select(*features, stages[-1].getLabelCol()), stages
        width = row_bytes(estimator, features)
        dealt, kept = spread(rows, width), rows.count() * width
        if mapping and PART_BYTES < kept <= MAPPED_BYTES:
            # Beyond the exchange no task of the solver, which has hundreds of steps, is sent how rows are mapped.
            ready = PipelineModel([_assembler(features), *mapping])
            mapped = ready.transform(dealt).select(last.getFeaturesCol(), last.getLabelCol())
            parts = max(-(-kept // PART_BYTES), df.sparkSession.sparkContext.defaultParallelism)
            model = PipelineModel([*ready.stages, last.fit(mapped.repartition(parts))])
        else:
            model = Pipeline(stages=[_assembler(features), *stages]).fit(dealt)
    return collapse_small_nodes(df.sparkSession, model, min_samples_split) if min_samples_split else model


def collapse_small_nodes(spark: SparkSession, model: PipelineModel, min_samples_split: int) -> PipelineModel:
    """The same trees without the splits of nodes that hold fewer rows.

    A tree is grown from the root without looking back, so leaving these splits out gives
    the tree that would have grown without them.  A node never holds more rows than its
    parent, so a node stays exactly if its parent may be split.  The trees are rewritten as
    the table of nodes they are stored as; the model at hand stays as it is.
    """
    return rewritten(spark, model, new_path(spark, "collapsed-model"), lambda nodes: _without_small_splits(nodes, min_samples_split))


def _without_small_splits(nodes: DataFrame, limit: int) -> DataFrame:
    """Nodes by tree, numbered from 0 in the order in which a tree is told from the root, left before right."""
    may_split = (F.col("leftChild") >= 0) & (F.col("rawCount") >= limit)
    children = nodes.where(may_split).select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"))
    roots = nodes.select("treeID", F.lit(0).alias("id")).distinct()
    kept = nodes.join(children.unionByName(roots), ["treeID", "id"], "left_semi")
    # A tree's nodes are held by the driver in any case, when the model is fitted and loaded.
    place = (F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1).cast("int")
    numbered = kept.withColumn("_place", place)
    places = numbered.select("treeID", F.col("id").alias("rightChild"), F.col("_place").alias("_right"))
    joined = numbered.join(places, ["treeID", "rightChild"], "left")
    leaf = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    return joined.select(
        "treeID",
        F.col("_place").alias("id"),
        "prediction",
        "impurity",
        "impurityStats",
        "rawCount",
        F.when(may_split, F.col("gain")).otherwise(-1.0).alias("gain"),
        F.when(may_split, F.col("_place") + 1).otherwise(-1).alias("leftChild"),
        F.when(may_split, F.col("_right")).otherwise(-1).alias("rightChild"),
        F.when(may_split, F.col("split")).otherwise(leaf).alias("split"),
    )


def tree_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The nodes of a fitted model's trees as stored, one row each."""
    path = new_path(spark, "model-nodes")
    save_model(model, path)
    return flat(spark.read.parquet(f"{path}/stages/{len(model.stages) - 1}_{model.stages[-1].uid}/data"))


def predict(df: DataFrame, model: PipelineModel, out: str = "prediction") -> DataFrame:
    """Add the predicted class or value; the model's own columns are dropped."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").alias(out))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """Load a saved model; a failure is raised, never taken for an absent model."""
    return PipelineModel.load(path)


def label_scores(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """The reply of a scoring request: the class as a number and as a label."""
    positive = F.col(prediction) > 0
    return df.withColumns(
        {
            "int_output": F.col(prediction).cast("int"),
            "str_output": F.when(positive, POSITIVE_LABEL).otherwise(NEGATIVE_LABEL),
        }
    )
