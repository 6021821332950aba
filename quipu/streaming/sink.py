"""A folder of batches that readers see whole or not at all.

A batch is written to a folder of its own and then committed to a log; what a task or a
driver left behind before that is never read.  A batch that is run again after a restart
finds its commit and writes nothing.  Small batches are merged into larger folders beside
them, by a commit that stands for the batches it holds: a reader takes the folders that
the log names at that moment, and none of these is touched by merging.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from quipu.sources.commits import CommitLog

BATCHES = "batches"
FOLDER = "committed_folder"  # folders look like values of this column, so that they are read as one table


@dataclass(frozen=True)
class Written:
    """A committed folder, the batches from ``first`` to ``last`` that it holds, and when it was committed."""

    first: int
    last: int
    folder: str
    at: float

    def covers(self, other: Written) -> bool:
        return self.first <= other.first and other.last <= self.last and self.last - self.first > other.last - other.first


class BatchSink:
    def __init__(self, spark: SparkSession, target: str, partition_by: list[str] | None = None) -> None:
        self.spark, self.target, self.partition_by = spark, target.rstrip("/"), partition_by or []
        self.log = CommitLog(spark, f"{self.target}/_log")

    def committed(self) -> list[Written]:
        """All commits: one row for each batch and each merged run of batches."""
        rows = self.log.lines().where(f"table = '{BATCHES}'").select("row", "folder").collect()
        return sorted((Written(**json.loads(r["row"]), folder=r["folder"]) for r in rows), key=lambda w: (w.first, -w.last))

    def current(self) -> list[Written]:
        """The commits that no other one stands for."""
        every = self.committed()
        found: list[Written] = []
        for one in every:  # a run of batches comes before the batches in it
            if not (found and found[-1].covers(one)):
                found.append(one)
        return found

    def write(self, rows: DataFrame, number: int) -> bool:
        """Write a batch once; false if it is there already."""
        if self._held(number):
            return False
        folder = f"{FOLDER}={number}-{uuid.uuid4().hex}"
        rows.write.partitionBy(*self.partition_by).parquet(f"{self.target}/{folder}")
        return self._commit(number, number, folder, lambda: self._held(number))

    def _held(self, number: int) -> bool:
        return any(w.first <= number <= w.last for w in self.committed())

    def _commit(self, first: int, last: int, folder: str, superseded) -> bool:
        """Commit a folder unless another writer has made it superfluous meanwhile."""
        row = json.dumps({"first": first, "last": last, "at": time.time()})
        while True:
            number = self.log.latest()
            if superseded():
                return False
            if self.log.try_commit(number + 1, [{"table": BATCHES, "row": row, "folder": folder}]):
                return True

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All committed batches as they stand now."""
        paths = [f"{self.target}/{w.folder}" for w in self.current()]
        if not paths:
            if schema is None:
                raise ValueError("no batch has been committed yet")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return self._of(reader, paths)

    def _of(self, reader: DataFrameReader, paths: list[str]) -> DataFrame:
        return reader.option("basePath", self.target).parquet(*paths).drop(FOLDER)

    def compact(self, least: int = 10, files: int = 1) -> list[Written]:
        """Merge every run of at least ``least`` neighbouring single batches into one folder of about ``files`` files a partition.

        Numbers need not follow each other without a gap: a batch without rows has none.
        """
        merged: list[Written] = []
        run: list[Written] = []
        for one in [*self.current(), None]:
            if one is not None and one.first == one.last:
                run.append(one)
                continue
            if len(run) >= least:
                merged.append(self._merge(run, files))
            run = []
        return [m for m in merged if m]

    def _merge(self, run: list[Written], files: int) -> Written | None:
        rows = self._of(self.spark.read, [f"{self.target}/{w.folder}" for w in run])
        rows = rows.repartition(files, *self.partition_by) if self.partition_by else rows.coalesce(files)
        first, last = run[0].first, run[-1].last
        folder = f"{FOLDER}={first}-{last}-{uuid.uuid4().hex}"
        rows.write.partitionBy(*self.partition_by).parquet(f"{self.target}/{folder}")
        done = self._commit(first, last, folder, lambda: any(w.first <= first and last <= w.last for w in self.committed()))
        return Written(first, last, folder, time.time()) if done else None

    def vacuum(self, older_than: float) -> list[str]:
        """Delete folders that another commit has stood for since ``older_than`` seconds, when no reader uses them any more."""
        every, kept = self.committed(), {w.folder for w in self.current()}
        gone = []
        for one in every:
            merged_at = min((w.at for w in every if w.covers(one)), default=None)
            if one.folder not in kept and merged_at is not None and merged_at < time.time() - older_than:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.target}/{one.folder}")
                if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True):
                    gone.append(one.folder)
        return gone
