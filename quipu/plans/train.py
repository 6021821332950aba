"""First training, retraining, and promotion of the better model."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quipu.functions.text import tags, trial_name
from quipu.operators import models
from quipu.operators.metrics import score
from quipu.operators.registry import challenge, decide
from quipu.operators.search import PARAMS, Search
from quipu.operators.stats import correlation_with_target, information_gain
from quipu.operators.trials import mean_of_folds
from quipu.session import local_frame
from quipu.sources.documents import signature, write_json
from quipu.sources.store import Store

# The alias of the model in use, and the prefixes of run names.
CHAMPION = "champion"
CHALLENGER_RUN = "Challenger_"
SEARCH_RUN = "best_hyperparam_"


def fit_and_log(
    store: Store,
    experiment: str,
    name: str,
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str,
    estimator: Estimator | None,
    metric: str,
) -> tuple[int, float]:
    """Fit, score on the test rows, log the run, save the model, add its version.

    Without an estimator this is the production forest, which does not split small nodes.
    """
    small = models.MIN_SAMPLES_SPLIT if estimator is None else None
    estimator = estimator or models.forest_classifier(label)
    model = models.fit(train, estimator, features, small)
    value = score(models.predict(test, model), metric, label, "prediction").first()[metric]
    params = {p.name: v for p, v in estimator.extractParamMap().items()}
    if small:
        params["minSamplesSplit"] = small
    params["model"] = type(estimator).__name__
    store.get_or_create_experiment(experiment)
    run_name = f"{CHALLENGER_RUN}{datetime.now():%Y%m%d_%H%M%S}"
    run_id = store.log_run(experiment, run_name, params, {metric: value}, {"experiment": "challenger models"})
    source = f"{store.root}/artifacts/{run_id}/model"
    models.save_model(model, source)
    described = signature(models.predict(train, model), features, "prediction")
    write_json(described, f"{store.root}/artifacts/{run_id}/signature")
    return store.register(name, source, run_id, {**params, metric: value}), value


def train_initial(
    store: Store,
    experiment: str,
    name: str,
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str,
    estimator: Estimator | None = None,
    metric: str = "f1",
) -> int:
    """Train a first model and make it champion without a comparison."""
    version, value = fit_and_log(
        store, experiment, name, train, test, features, label, estimator, metric
    )
    store.set_alias(name, CHAMPION, version, metric, None, value)
    return version


def retrain(
    store: Store,
    experiment: str,
    name: str,
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str,
    estimator: Estimator | None = None,
    metric: str = "accuracy",
) -> Row:
    """Train a challenger and promote it if it is strictly better by the metric."""
    version, value = fit_and_log(
        store, experiment, name, train, test, features, label, estimator, metric
    )
    return promote(store, name, test, label, version, value, metric)


def promote(
    store: Store, name: str, test: DataFrame, label: str, version: int, value: float, metric: str = "accuracy"
) -> Row:
    """Decide between the champion and a challenger of known score.

    The metric and both scores are stored with the promotion.

    Without a champion the newest version in no stage is promoted.  "Without"
    means that there is no alias: a champion that cannot be loaded is an error.
    """
    standing = store.resolve(name, CHAMPION)
    if standing is None:
        newest = store.latest(name)
        if newest is None:
            raise LookupError(f"model {name} has no version to promote")
        store.set_alias(name, CHAMPION, newest["version"], metric, None, value)
        return _decision(store, None, value)
    champion = models.load_model(store.spark, standing["source"])
    scored = score(models.predict(test, champion), metric, label, "prediction").first()[metric]
    decision = _decision(store, scored, value)
    if decision["promote"]:
        store.set_alias(name, CHAMPION, version, metric, scored, value)
    return decision


def _decision(store: Store, champion: float | None, challenger: float) -> Row:
    schema = "champion_score double, challenger_score double"
    return decide(local_frame(store.spark, [(champion, challenger)], schema)).first()


def compare(test: DataFrame, label: str, champion: PipelineModel, challenger: PipelineModel) -> DataFrame:
    """Both models on the same rows, read once, and the decision."""
    both = models.predict(models.predict(test, champion, "champion"), challenger, "challenger")
    return challenge(both, label, "champion", "challenger")


def log_search(store: Store, experiment: str, found: Search, metric: str = "f1") -> str:
    """Log a search: one run for the whole, and under it one run per trial."""
    store.get_or_create_experiment(experiment)
    best = {p: found.best[p] for p in PARAMS if found.best[p] is not None}
    name = f"{SEARCH_RUN}{datetime.now():%Y/%m/%d-%H:%M:%S}"
    parent = store.log_run(experiment, name, best, {f"best_train_{metric}": found.best["mean_score"]})
    means = mean_of_folds(found.scores).join(F.broadcast(found.trials), "trial")
    params = F.map_filter(tags(**{p: F.col(p) for p in PARAMS}), lambda _, value: value.isNotNull())
    runs = means.select(
        F.expr("uuid()").alias("run_id"),
        F.lit(parent).alias("parent_run_id"),
        F.lit(experiment).alias("experiment"),
        trial_name(F.col("trial")).alias("name"),
        params.alias("params"),
        F.create_map(F.lit(metric), F.col("mean_score")).alias("metrics"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.current_timestamp().alias("started_at"),
    )
    store.append_rows("runs", runs)
    return parent


def publish_search(
    store: Store, experiment: str, name: str, found: Search, train: DataFrame, test: DataFrame, features: list[str], label: str, metric: str = "f1"
) -> tuple[int, float]:
    """Log a search, score its refitted winner on the test rows, and make it champion.

    The model is saved with its signature, its version carries the winner's
    parameters and score, and the association reports stay with the run.
    """
    parent = log_search(store, experiment, found, metric)
    value = score(models.predict(test, found.model), metric, label, "prediction").first()[metric]
    folder = f"{store.root}/artifacts/{parent}"
    models.save_model(found.model, f"{folder}/model")
    write_json(signature(models.predict(train, found.model), features, "prediction"), f"{folder}/signature")
    correlation_with_target(train, features, label).write.parquet(f"{folder}/correlation")
    information_gain(train, features, label).write.parquet(f"{folder}/information-gain")
    best = {p: found.best[p] for p in PARAMS if found.best[p] is not None}
    version = store.register(name, f"{folder}/model", parent, {**best, f"test_{metric}": value})
    store.set_alias(name, CHAMPION, version, metric, None, value)
    return version, value
