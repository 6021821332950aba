"""Scoring of requests as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quipu.operators.encode import Dictionary
from quipu.plans.score import Scored, outcomes, split_outcomes
from quipu.schema import Table
from quipu.sources.store import Store
from quipu.streaming.sink import BatchSink


def request_stream(spark: SparkSession, folder: str, schema: T.StructType, **options: str) -> DataFrame:
    """Request rows from the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(folder)


def read_scored(spark: SparkSession, target: str, keep: list[str]) -> Scored:
    """What a stream has committed so far."""
    written = BatchSink(spark, target, ["valid"]).read()
    return split_outcomes(written.withColumn("valid", F.col("valid").cast("boolean")), keep)


class CurrentModel:
    """The model an alias stands for, loaded again when its version changes."""

    def __init__(self, store: Store, name: str, alias: str = "champion") -> None:
        self.store, self.name, self.alias = store, name, alias
        self.version: int | None = None
        self.model: PipelineModel | None = None

    def get(self) -> PipelineModel:
        found = self.store.resolve(self.name, self.alias)
        if found is None:
            raise LookupError(f"model {self.name} has no alias {self.alias}")
        if found["version"] != self.version:
            self.model, self.version = self.store.load(self.name, self.alias)
        return self.model


def score_stream(
    requests: DataFrame,
    body: str,
    spec: Table,
    dictionary: Dictionary,
    model: CurrentModel | PipelineModel,
    keep: list[str],
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Write the outcome of each batch once, by validity, under ``target``.

    A batch is committed when it is written, so a restart leaves neither gaps nor doubles,
    and readers never see half of one.  With ``compact_every`` so many batches are merged
    into larger files whenever they have come together.
    """
    sink = BatchSink(requests.sparkSession, target, ["valid"])

    def write(batch: DataFrame, number: int) -> None:
        current = model.get() if isinstance(model, CurrentModel) else model
        sink.write(outcomes(batch, body, spec, dictionary, current, keep), number)
        if compact_every and (number + 1) % compact_every == 0:
            sink.compact(compact_every)

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
