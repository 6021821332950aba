"""Run log and model registry as append-only tables under one folder.

What is appended is a commit of a shared log, so there may be several writers: versions
are numbered without gap or double, and a name is created once.  An alias is never changed
in place: the row that was promoted last stands.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quipu.operators import models, registry
from quipu.session import local_frame
from quipu.sources.commits import ROW_OPTIONS, CommitLog, row_lines

SCHEMAS = {
    "experiments": "name string, experiment_id string, created_at timestamp",
    "runs": (
        "run_id string, parent_run_id string, experiment string, name string, params map<string,string>, "
        "metrics map<string,double>, tags map<string,string>, started_at timestamp"
    ),
    "registered_models": "name string, description string, created_at timestamp",
    "model_versions": (
        "name string, version int, source string, run_id string, stage string, tags map<string,string>"
    ),
    "model_aliases": (
        "name string, alias string, version int, promoted_at timestamp, "
        "metric string, champion_score double, challenger_score double"
    ),
}


def _now() -> datetime:
    return datetime.now(timezone.utc)


class Store:
    """The registry's tables and the few writes that keep its rules."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def table(self, name: str) -> DataFrame:
        """The table as it stands now; empty before its first write."""
        lines = self.log.lines().where(F.col("table") == name)
        rows = lines.where("row IS NOT NULL").select(F.from_json("row", SCHEMAS[name], ROW_OPTIONS).alias("r")).select("r.*")
        # One folder per search that was logged.
        folders = [f"{self.root}/{r['folder']}" for r in lines.where("folder IS NOT NULL").select("folder").collect()]
        return rows.unionByName(self.spark.read.schema(SCHEMAS[name]).parquet(*folders)) if folders else rows

    def append(self, name: str, rows: list[tuple]) -> None:
        self.log.append(self._lines(name, rows))

    def _lines(self, name: str, rows: list[tuple]) -> list[dict]:
        return row_lines(name, local_frame(self.spark, rows, SCHEMAS[name]))

    def append_rows(self, name: str, rows: DataFrame) -> None:
        """Append a table of any size: it is written first, and then committed at once."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        columns = local_frame(self.spark, [], SCHEMAS[name]).columns
        rows.select(*columns).write.parquet(f"{self.root}/{folder}")
        self.log.append([{"table": name, "folder": folder}])

    def get_or_create_experiment(self, name: str) -> str:
        self._append_absent("experiments", (name, uuid.uuid4().hex, _now()))
        return self.table("experiments").filter(F.col("name") == name).first()["experiment_id"]

    def create_model_if_absent(self, name: str, description: str | None = None) -> None:
        self._append_absent("registered_models", (name, description, _now()))

    def _append_absent(self, table: str, row: tuple) -> None:
        """Append the row unless its name, which comes first, is there; whoever commits first wins."""
        new = local_frame(self.spark, [row], SCHEMAS[table])
        while True:
            number = self.log.latest()
            missing = registry.absent_from(new, self.table(table), ["name"])
            if missing.isEmpty() or self.log.try_commit(number + 1, row_lines(table, new)):
                return

    def log_run(
        self,
        experiment: str,
        name: str,
        params: dict[str, object] | None = None,
        metrics: dict[str, float] | None = None,
        tags: dict[str, str] | None = None,
        parent: str | None = None,
    ) -> str:
        run_id = uuid.uuid4().hex
        texts = {k: str(v) for k, v in (params or {}).items()}
        numbers = {k: float(v) for k, v in (metrics or {}).items()}
        self.append("runs", [(run_id, parent, experiment, name, texts, numbers, tags or {}, _now())])
        return run_id

    def register(
        self, name: str, source: str, run_id: str, tags: dict[str, object] | None = None
    ) -> int:
        """Add the next version of a model, creating the model if it is new."""
        self.create_model_if_absent(name)
        texts = {k: str(v) for k, v in (tags or {}).items()}
        number = self.log.latest()
        version = (self.table("model_versions").filter(F.col("name") == name).agg(F.max("version")).first()[0] or 0) + 1
        while True:
            row = (name, version, source, run_id, registry.NO_STAGE, texts)
            if self.log.try_commit(number + 1, self._lines("model_versions", [row])):
                return version
            # Another writer was faster: what it committed tells whether the version is taken.
            number += 1
            for line in self.log.commit_lines(number):
                if line["table"] == "model_versions" and json.loads(line["row"])["name"] == name:
                    version = max(version, json.loads(line["row"])["version"] + 1)

    def set_alias(
        self,
        name: str,
        alias: str,
        version: int,
        metric: str | None = None,
        champion_score: float | None = None,
        challenger_score: float | None = None,
    ) -> None:
        """Let an alias stand for a version, with the scores that decided it."""
        known = self.table("model_versions").filter((F.col("name") == name) & (F.col("version") == version))
        if known.isEmpty():
            raise ValueError(f"model {name} has no version {version}")
        self.append("model_aliases", [(name, alias, version, _now(), metric, champion_score, challenger_score)])

    def resolve(self, name: str, alias: str) -> Row | None:
        """The version an alias stands for, or None when there is no such alias."""
        found = registry.resolve_alias(
            self.table("model_aliases").filter(F.col("name") == name),
            self.table("model_versions").filter(F.col("name") == name),
            alias,
        )
        return found.first()

    def latest(self, name: str) -> Row | None:
        return registry.latest_version(self.table("model_versions").filter(F.col("name") == name)).first()

    def load(self, name: str, alias: str) -> tuple[PipelineModel, int]:
        found = self.resolve(name, alias)
        if found is None:
            raise LookupError(f"model {name} has no alias {alias}")
        return models.load_model(self.spark, found["source"]), found["version"]
