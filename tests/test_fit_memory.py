"""Fits keep a bounded part of their rows in one task, and side by side no more than there is room for."""

import threading
import time

from quipu.operators import kernels, models
from quipu.session import Room, cache_bytes

FEATURES = ["a", "b"]


def table(spark):
    rows = spark.range(40_000, numPartitions=1)
    return rows.selectExpr("id % 7 AS a", "id % 11 AS b", "int(id % 7 > 3) AS y")


def test_rows_in_one_file_are_dealt_to_parts_by_what_a_fit_keeps(spark, monkeypatch):
    seen = []
    deal = models.spread
    monkeypatch.setattr(models, "spread", lambda *a: seen.append(deal(*a)) or seen[-1])
    monkeypatch.setattr(models, "PART_BYTES", 100_000)
    poly = kernels.kernel_svm(table(spark), FEATURES, "y", "poly", 1.0, 40_000, 2, maxIter=2)
    models.fit(table(spark), poly, FEATURES)
    models.fit(table(spark), models.tree_classifier("y", 2), FEATURES)
    assert [models.row_bytes(e, FEATURES) for e in (poly, models.tree_classifier("y", 2))] == [3 * 8, 200 + 8 + 12]
    assert [df.rdd.getNumPartitions() for df in seen] == [10, 88]
    assert all(df.count() == 40_000 for df in seen)


def test_mapped_rows_are_dealt_again_if_they_are_few(spark, monkeypatch, tmp_path):
    """The solver's rows come out of an exchange, and tasks behind it know nothing of the mapping."""
    seen = []
    solve = models.LinearSVC.fit
    monkeypatch.setattr(models.LinearSVC, "fit", lambda self, df: seen.append(df) or solve(self, df))
    monkeypatch.setattr(models, "PART_BYTES", 100_000)
    found = []
    for most in (1 << 30, 100_000):
        monkeypatch.setattr(models, "MAPPED_BYTES", most)
        model = models.fit(table(spark), kernels.kernel_svm(table(spark), FEATURES, "y", "poly", 1.0, 40_000, 2, maxIter=2), FEATURES)
        models.save_model(model, str(tmp_path / str(most)))
        loaded = models.load_model(spark, str(tmp_path / str(most)))
        found.append(sorted((r.a, r.b, r.prediction) for r in models.predict(table(spark), loaded).distinct().collect()))
    first = [df._jdf.queryExecution().optimizedPlan().toString().split()[0] for df in seen]
    assert first == ["Repartition", "Project"]
    assert [df.rdd.getNumPartitions() for df in seen] == [10, 10]
    assert found[0] == found[1]


def test_small_tables_are_not_dealt(spark):
    assert models.spread(table(spark), 100).rdd.getNumPartitions() == 1


def test_room_is_never_overdrawn():
    room, held, most = Room(10), [], []

    def work(need):
        with room.of(need):
            held.append(min(need, 10))
            most.append(sum(held))
            time.sleep(0.02)
            held.remove(min(need, 10))

    threads = [threading.Thread(target=work, args=(n,)) for n in (4, 4, 4, 25, 3, 10, 1)]
    [t.start() for t in threads]
    [t.join(5) for t in threads]
    assert len(most) == 7 and max(most) <= 10 and room.free == 10


def test_room_is_what_executors_keep(spark):
    assert cache_bytes(spark) > 1 << 28


def test_request_files_grow_in_number_and_not_in_size():
    from quipu.plans.queries import ROWS_PER_FILE, request_files

    assert [request_files(n) for n in (0, 150_000, 400_000)] == [4, 4, 4]
    for rows in (900_001, 9_000_000, 54_000_000):
        assert request_files(rows) % 2 == 0 and rows / request_files(rows) <= ROWS_PER_FILE
