"""Batches that are committed once, and merged under their readers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quipu.streaming.sink import BatchSink


@pytest.fixture
def sink(spark, tmp_path):
    return BatchSink(spark, str(tmp_path / "t"), ["valid"])


def batch(spark, n, rows=20):
    return spark.range(n * rows, (n + 1) * rows).select("id", (F.col("id") % 2 == 0).alias("valid")).repartition(3)


def ids(sink):
    return sorted(r.id for r in sink.read().collect())


def test_a_batch_is_written_once(spark, sink):
    assert sink.write(batch(spark, 0), 0) and sink.write(batch(spark, 1), 1)
    assert not sink.write(batch(spark, 1), 1)  # run again after a restart
    assert ids(sink) == list(range(40))
    with ThreadPoolExecutor(max_workers=4) as pool:
        done = list(pool.map(lambda _: BatchSink(spark, sink.target, ["valid"]).write(batch(spark, 2), 2), range(4)))
    assert sum(done) == 1 and ids(sink) == list(range(60))


def test_a_killed_batch_is_not_seen(spark, sink, tmp_path):
    sink.write(batch(spark, 0), 0)
    broken = batch(spark, 1).withColumn("id", F.when(F.col("id") > 30, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException, match="killed"):
        sink.write(broken, 1)
    # Written whole, but the driver died before the commit.
    batch(spark, 1).write.partitionBy("valid").parquet(f"{sink.target}/committed_folder=1-dead")
    assert ids(sink) == list(range(20))
    assert BatchSink(spark, sink.target, ["valid"]).write(batch(spark, 1), 1)
    assert ids(sink) == list(range(40))


def test_merging_under_a_reader(spark, sink):
    for n in range(6):
        sink.write(batch(spark, n), n)
    reader = sink.read()  # the folders are chosen now
    before = {w.folder for w in sink.current()}
    (merged,) = sink.compact(least=3)
    assert (merged.first, merged.last) == (0, 5) and [w.folder for w in sink.current()] == [merged.folder]
    assert sorted(r.id for r in reader.collect()) == ids(sink) == list(range(120))
    assert not sink.write(batch(spark, 3), 3)  # a batch within the run is there
    sink.write(batch(spark, 6), 6)
    assert ids(sink) == list(range(140)) and sink.compact(least=3) == []
    assert sink.vacuum(older_than=3600) == [] and sorted(r.id for r in reader.collect()) == list(range(120))
    assert set(sink.vacuum(older_than=-1)) == before
    assert ids(sink) == list(range(140)) and len(sink.read().inputFiles()) <= 2 + 6


def test_gaps_between_batches_and_two_mergers(spark, sink):
    for n in (0, 2, 5, 9):
        sink.write(batch(spark, n), n)
    with ThreadPoolExecutor(max_workers=2) as pool:
        done = [m for found in pool.map(lambda _: BatchSink(spark, sink.target, ["valid"]).compact(least=2), range(2)) for m in found]
    assert len(done) == 1 and len(sink.current()) == 1
    assert ids(sink) == sorted(i for n in (0, 2, 5, 9) for i in range(n * 20, n * 20 + 20))


def test_nothing_committed(spark, sink):
    with pytest.raises(ValueError, match="no batch"):
        sink.read()
    assert sink.read(batch(spark, 0).schema).collect() == [] and sink.compact() == []
