import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quipu.operators import encode, models, search, trials, validate
from quipu.plans import score, train
from quipu.schema import LONG, MARRIAGES, TEXT, Field, Table
from quipu.session import materialize, shared_dir
from quipu.sources.requests import parse_requests
from quipu.sources.store import Store
from quipu.streaming.score import CurrentModel, read_scored, request_stream, score_stream

NUMBERS = {"dur_mat": 21, "hijos_2": 5, "edad_2": 52, "edad_1": 47, "hijos_rec": 4}
GOOD = {name: NUMBERS.get(name, f"{name} value") for name in MARRIAGES.features}


def _request(**changes):
    body = {**GOOD, **changes}
    return json.dumps({"features": {k: v for k, v in body.items() if v is not None}})


@pytest.mark.parametrize(
    "changes, missing, violations",
    [
        ({}, [], []),
        ({"dur_mat": 0}, [], []),
        ({"dur_mat": 65}, [], []),
        ({"dur_mat": -1}, [], ["dur_mat"]),
        ({"dur_mat": 66, "hijos_rec": 13}, [], ["dur_mat", "hijos_rec"]),
        ({"hijos_2": 150, "edad_1": 120, "edad_2": 121}, [], ["edad_2"]),
        ({"area_1": None}, ["area_1"], []),
        ({"edad_1": "mucho"}, ["edad_1"], []),
        ({"edad_1": 3.5}, ["edad_1"], []),
        ({"edad_1": 38.0, "edad_2": "38"}, [], []),
        ({"edad_1": "121.0"}, [], ["edad_1"]),
        ({"edad_1": True}, ["edad_1"], []),
    ],
)
def test_requests_are_checked(spark, changes, missing, violations):
    df = spark.createDataFrame([(1, _request(**changes))], "id long, body string")
    row = validate.route(parse_requests(df, "body", MARRIAGES, ["id"]), MARRIAGES).first()
    assert (row.missing, row.violations) == (missing, violations)
    assert row.valid is (not missing and not violations)


def test_unreadable_requests(spark):
    bodies = ["{", "[]", "null", '{"other": 1}', ""]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    rows = validate.route(parse_requests(df, "body", MARRIAGES, ["id"]), MARRIAGES).collect()
    assert len(rows) == 5 and not any(r.valid for r in rows)


def test_one_sided_bounds(spark):
    spec = Table((Field("a", LONG, low=1), Field("b", LONG, high=2), Field("c", TEXT)), "y")
    df = spark.createDataFrame([(0, 3, "x"), (1, 2, "x"), (None, None, None)], "a long, b long, c string")
    assert [r.violations for r in validate.check_ranges(df, spec).collect()] == [["a", "b"], [], []]


SPEC = Table((Field("n", LONG, 0, 9), Field("t", TEXT)), "y", key="id")


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.range(400).select(
        "id", (F.col("id") % 10).alias("n"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("t")
    )
    rows = rows.withColumn("y", (F.col("n") > 4).cast("int"))
    dictionary = encode.fit_dictionary(rows, ["t"])
    coded = materialize(encode.encode(rows, dictionary).coalesce(2), "coded")
    return dictionary, coded, models.fit(coded, models.tree_classifier("y", 2), SPEC.features)


@pytest.fixture(scope="module")
def requests(spark):
    body = F.to_json(F.struct(F.struct((F.col("id") % 12).alias("n"), F.expr("if(id % 7 = 0, 'z', 'a')").alias("t")).alias("features")))
    return spark.range(300).select("id", body.alias("body"))


def test_scores_and_reasons(requests, trained):
    dictionary, _, model = trained
    scored = score.score_requests(requests, "body", SPEC, dictionary, model, ["id"])
    replies = {r.id: r for r in scored.accepted.collect()}
    bad = {r.id: r for r in scored.quarantined.collect()}
    assert len(replies) + len(bad) == 300
    for i in range(300):
        reasons = (["n"] if i % 12 > 9 else [], ["t"] if i % 7 == 0 else [])
        if any(reasons):
            assert (bad[i].violations, bad[i].unseen) == reasons
        else:
            positive = i % 12 > 4
            assert replies[i].int_output == positive
            assert replies[i].str_output == ("Divorcio" if positive else "No divorcio")


def test_stream_equals_batch_and_follows_the_champion(spark, requests, trained, tmp_path):
    dictionary, coded, model = trained
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    store = Store(spark, str(tmp_path / "store"))
    run = store.log_run("e", "r")

    def publish(label, name):
        path = str(tmp_path / name)
        models.save_model(models.fit(label(coded), models.tree_classifier("y", 2), SPEC.features), path)
        store.set_alias("m", "champion", store.register("m", path, run))

    def scored_by(current):
        score_stream(
            request_stream(spark, source, requests.schema), "body", SPEC, dictionary, current, ["id"],
            target, str(tmp_path / "checkpoint"),
        ).awaitTermination()
        return {r.id: r.int_output for r in read_scored(spark, target, ["id"]).accepted.collect()}

    batch = score.score_requests(requests, "body", SPEC, dictionary, model, ["id"])
    expected = {r.id: r.int_output for r in batch.accepted.collect()}
    current = CurrentModel(store, "m")
    with pytest.raises(LookupError):
        current.get()
    publish(lambda df: df, "first")
    requests.filter("id < 150").write.mode("append").parquet(source)
    assert scored_by(current) == {i: v for i, v in expected.items() if i < 150}
    assert current.version == 1
    loaded = current.model
    assert current.get() is loaded

    publish(lambda df: df.withColumn("y", 1 - F.col("y")), "second")
    requests.filter("id >= 150").write.mode("append").parquet(source)
    assert scored_by(current) == {i: v if i < 150 else 1 - v for i, v in expected.items()}
    assert current.version == 2
    bad = read_scored(spark, target, ["id"]).quarantined
    sent = {r.id: r.body for r in requests.collect()}
    assert all(r.body == sent[r.id] for r in bad.collect())
    assert {r.id for r in bad.select("id").collect()} == {r.id for r in batch.quarantined.select("id").collect()}


def test_stream_leaves_nothing_in_the_shared_folder(spark, requests, trained, tmp_path):
    dictionary, _, model = trained
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    requests.repartition(6).write.parquet(source)
    shared = Path(shared_dir(spark)) / "quipu"
    before = {p for p in shared.rglob("*") if p.is_dir()}
    stream = request_stream(spark, source, requests.schema, maxFilesPerTrigger="2")
    score_stream(stream, "body", SPEC, dictionary, model, ["id"], target, str(tmp_path / "checkpoint")).awaitTermination()
    assert len(list(Path(target).glob("committed_folder=*"))) >= 3
    assert {p for p in shared.rglob("*") if p.is_dir()} == before


def test_deeper_trees_than_spark_grows_are_refused():
    with pytest.raises(ValueError, match="30"):
        models.tree_classifier("y", 32)
    with pytest.raises(ValueError, match="30"):
        models.small_forest("y", 31, 2)
    assert models.tree_classifier("y", 30).getMaxDepth() == 30 == models.small_forest("y", 30, 2).getMaxDepth()
    assert trials.TREE_DEPTH[1] == trials.FOREST_DEPTH[1] == 30
    forest = models.forest_classifier("y")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (100, 10, 2)
    assert models.linear_svm("y", 0.5, 100).getRegParam() == pytest.approx(0.02)


def test_codes_beyond_max_bins_train(spark):
    df = spark.range(600).select((F.col("id") % 221).alias("code"), (F.col("id") % 221 > 100).cast("int").alias("y"))
    model = models.fit(df, models.forest_classifier("y", numTrees=3, maxDepth=4, featureSubsetStrategy="all"), ["code"])
    assert models.predict(df, model).filter("prediction = y").count() > 580


def test_search_finds_and_refits_the_best(spark, trained, tmp_path):
    _, coded, _ = trained
    folded = coded.withColumn("fold", (F.col("id") % 3).cast("int"))
    found = search.model_search(folded, SPEC.features, "y", n_trials=2, seed=4, parallelism=2)
    assert found.scores.count() == 6
    best = max(r.mean_score for r in search.mean_of_folds(found.scores).collect())
    assert found.best.mean_score == best
    assert models.predict(coded, found.model).count() == 400

    store = Store(spark, str(tmp_path / "store"))
    parent = train.log_search(store, "search", found)
    runs = {r.name: r for r in store.table("runs").collect()}
    assert len(runs) == 3 and runs["Trial: 0"].parent_run_id == parent == runs["Trial: 1"].parent_run_id
    assert max(r.metrics["f1"] for n, r in runs.items() if n.startswith("Trial")) == best
    top = next(r for r in runs.values() if r.run_id == parent)
    assert top.metrics == {"best_train_f1": best} and top.params["classifier"] == found.best["classifier"]
    assert top.params == runs[f"Trial: {found.best['trial']}"].params
