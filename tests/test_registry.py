from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from quipu.operators import models, registry
from quipu.plans import train
from quipu.sources.commits import CommitLog
from quipu.sources.store import Store


@pytest.mark.parametrize(
    "champion, challenger, promote",
    [(0.8, 0.9, True), (0.9, 0.9, False), (0.9, 0.8, False), (None, 0.1, True), (None, None, False)],
)
def test_only_a_strictly_better_challenger_wins(spark, champion, challenger, promote):
    row = registry.decide(
        spark.createDataFrame([(champion, challenger)], "champion_score double, challenger_score double")
    ).first()
    assert row.promote is promote and row.winner == ("challenger" if promote else "champion")


def test_merge_keeps_old_keys_and_new_values(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    new = spark.createDataFrame([("b", None), ("c", "3")], "key string, value string")
    found = {r.key: r.value for r in registry.merge_entries(old, new, ["key"]).collect()}
    assert found == {"a": "1", "b": None, "c": "3"}


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "name string, id int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "name string, id int")
    assert {tuple(r) for r in registry.insert_if_absent(old, new, ["name"]).collect()} == {("a", 1), ("b", 2)}


def test_alias_is_the_last_promotion(spark):
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    aliases = spark.createDataFrame(
        [("m", "champion", "1", day[0]), ("m", "champion", "3", day[2]), ("m", "champion", "2", day[2]), ("n", "x", "1", day[1])],
        "name string, alias string, version string, promoted_at timestamp",
    )
    versions = spark.createDataFrame(
        [("m", str(v), f"src{v}", f"run{v}") for v in (1, 2, 3)], "name string, version string, source string, run_id string"
    )
    found = registry.resolve_alias(aliases, versions, "champion").collect()
    assert [tuple(r) for r in found] == [("m", "champion", 3, "src3", "run3")]


def test_versions_go_on_from_the_highest(spark):
    new = spark.createDataFrame([("a", 5), ("a", 2), ("b", 1)], "name string, seq int")
    old = spark.createDataFrame([("a", 7), ("a", 3), ("c", 1)], "name string, version int")
    found = {(r.name, r.seq): r.version for r in registry.assign_versions(new, old, "seq").collect()}
    assert found == {("a", 2): 8, ("a", 5): 9, ("b", 1): 1}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_store_rules(store):
    first = store.get_or_create_experiment("e")
    assert store.get_or_create_experiment("e") == first
    assert store.resolve("m", "champion") is None and store.latest("m") is None
    run = store.log_run("e", "r", {"depth": 3}, {"f1": 0.5}, parent="p")
    logged = store.table("runs").first()
    assert logged.run_id == run and logged.params == {"depth": "3"} and logged.metrics == {"f1": 0.5}
    assert [store.register("m", f"s{i}", run) for i in range(3)] == [1, 2, 3]
    assert store.register("other", "s", run) == 1
    assert store.latest("m").version == 3
    store.set_alias("m", "champion", 2)
    assert store.resolve("m", "champion").source == "s1"
    store.set_alias("m", "champion", 1)
    assert store.resolve("m", "champion").version == 1
    with pytest.raises(ValueError):
        store.set_alias("m", "champion", 9)
    assert store.table("registered_models").count() == 2


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(float(i % 10), float(i % 3), int(i % 10 > 4)) for i in range(200)], "a double, b double, y int")


def test_retraining_promotes_only_better_models(store, rows):
    common = (store, "e", "m", rows, rows, ["a", "b"], "y")
    bad = (store, "e", "m", rows, rows, ["b"], "y")
    assert train.train_initial(*bad, models.tree_classifier("y", 1)) == 1
    worse = train.retrain(*bad, models.tree_classifier("y", 1))
    assert not worse.promote and store.resolve("m", "champion").version == 1
    better = train.retrain(*common, models.tree_classifier("y", 2), metric="f1")
    assert better.promote and better.challenger_score == 1.0 > better.champion_score
    model, version = store.load("m", "champion")
    assert version == 3 and models.predict(rows, model).filter("prediction = y").count() == 200
    standing = store.table("model_aliases").filter("version = 3").first()
    assert (standing.metric, standing.challenger_score, standing.champion_score) == ("f1", 1.0, better.champion_score)


def test_a_null_name_is_inserted_once(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "name string, id int")
    assert registry.absent_from(old, old, ["name"]).count() == 0
    assert registry.absent_from(old, old.filter("name = 'a'"), ["name"]).count() == 1


def test_without_a_champion_the_newest_is_promoted(store, rows):
    common = (store, "e", "m", rows, rows, ["a", "b"], "y")
    assert train.retrain(*common, models.tree_classifier("y", 2)).promote
    assert store.resolve("m", "champion").version == 1
    again = train.retrain(*common, models.tree_classifier("y", 2))
    assert not again.promote and again.champion_score == again.challenger_score == 1.0
    assert store.resolve("m", "champion").version == 1


def test_a_champion_that_cannot_be_loaded_is_an_error(store, rows, tmp_path):
    run = store.log_run("e", "r")
    store.set_alias("m", "champion", store.register("m", str(tmp_path / "nothing"), run))
    with pytest.raises(Exception, match="nothing"):
        train.promote(store, "m", rows, "y", 1, 0.9)
    assert store.resolve("m", "champion").version == 1


# several writers


def test_eight_writers_register_without_gap_or_double(spark, tmp_path):
    """200 versions of three models, by writers that do not know of each other, over several checkpoints."""
    root = str(tmp_path / "store")

    def write(writer):
        own = Store(spark, root)
        return [(m, own.register(m, f"src-{writer}-{i}", f"run-{writer}-{i}", {"writer": writer})) for i in range(25) for m in [f"m{(writer + i) % 3}"]]

    with ThreadPoolExecutor(max_workers=8) as pool:
        told = [pair for found in pool.map(write, range(8)) for pair in found]
    store = Store(spark, root)
    rows = store.table("model_versions").collect()
    assert len(rows) == 200 and sorted((r.name, r.version) for r in rows) == sorted(told)
    for name, n in Counter(r.name for r in rows).items():
        assert sorted(r.version for r in rows if r.name == name) == list(range(1, n + 1))
    assert len({r.source for r in rows}) == 200
    assert store.table("registered_models").count() == 3
    assert store.log.latest() == 203
    assert sum(n.endswith(".pointer") for n in store.log._names()) == 4


def test_commits_are_created_once(spark, tmp_path):
    log, other = (CommitLog(spark, str(tmp_path / "a log"), checkpoint_every=3) for _ in range(2))
    assert log.latest() == 0 and log.lines().collect() == []
    assert log.try_commit(1, [{"table": "t", "row": '{"a":"\u00f1\\n"}'}])
    assert not other.try_commit(1, [{"table": "t", "row": "late"}])
    assert [other.append([{"table": "t", "row": str(i)}]) for i in range(5)] == [2, 3, 4, 5, 6]
    assert log.commit_lines(1) == [{"table": "t", "row": '{"a":"\u00f1\\n"}'}]
    assert sorted(r.row for r in log.lines().collect()) == sorted(['{"a":"\u00f1\\n"}', "0", "1", "2", "3", "4"])
    with ThreadPoolExecutor(max_workers=8) as pool:
        wins = list(pool.map(lambda i: CommitLog(spark, str(tmp_path / "a log")).try_commit(7, [{"table": "t", "row": f"w{i}"}]), range(16)))
    assert sum(wins) == 1


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    log.append([{"table": "t", "row": "1"}])
    (tmp_path / "log" / ".000000000002.json.dead").write_text('{"table": "t", "row": "half')
    assert log.latest() == 1 and log.lines().count() == 1 and log.append([{"table": "t", "row": "2"}]) == 2


def test_rows_keep_their_types(store):
    store.log_run("e", "r", {"p": 1}, {"m": 0.1 + 0.2, "n": float("nan")}, {"t": "\u00e9 \""}, None)
    run = store.table("runs").first()
    assert run.params == {"p": "1"} and run.metrics["m"] == 0.1 + 0.2 and run.tags == {"t": "\u00e9 \""} and run.parent_run_id is None
    assert isinstance(run.started_at, datetime)


def test_an_experiment_is_created_once(spark, tmp_path):
    with ThreadPoolExecutor(max_workers=6) as pool:
        ids = set(pool.map(lambda _: Store(spark, str(tmp_path / "s")).get_or_create_experiment("e"), range(6)))
    assert len(ids) == 1 and Store(spark, str(tmp_path / "s")).table("experiments").count() == 1
