"""Session settings, the shared folder, and written intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SHARED_DIR_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def local_session(app: str = "quipu", cores: int | str = 8, memory: str = "16g", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine.

    On a cluster the session comes from ``spark-submit`` with its own settings;
    nothing in the package depends on the ones chosen here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores if isinstance(cores, int) else 8))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    The setting of the session is used as it is.  Only a local session may run
    without one, and then gets a temporary folder; on a cluster a machine-local
    folder would be lost with its machine, so a missing setting is an error.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # a local cluster has executors of its own
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="quipu-")
    return _local_dirs[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative model fits a checkpoint folder, unless there is one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/checkpoints")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses.

    All paths of an application lie under one folder, which its owner can remove
    when the application has ended.
    """
    return f"{shared_dir(spark)}/quipu/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, fixes the
    rows of plans that must be read more than once, and lets the planner see
    the true size of the table.
    """
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def cache_bytes(spark: SparkSession) -> int:
    """How much the executors can keep in memory together."""
    context = spark.sparkContext._jsc.sc()
    driver = context.env().blockManager().blockManagerId().hostPort()
    found, each = {}, context.getExecutorMemoryStatus().iterator()
    while each.hasNext():
        one = each.next()
        found[one._1()] = one._2()._1()
    return sum(n for at, n in found.items() if at != driver) or found[driver]


class Room:
    """Lets threads in while what they say they need is free; one that needs more than there is gets in alone."""

    def __init__(self, size: int) -> None:
        self.size, self.free, self.changed = size, size, threading.Condition()

    @contextmanager
    def of(self, need: int) -> Iterator[None]:
        need = min(need, self.size)
        with self.changed:
            self.changed.wait_for(lambda: self.free >= need)
            self.free -= need
        try:
            yield
        finally:
            with self.changed:
                self.free += need
                self.changed.notify_all()


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows made on the driver, as a table whose size the planner knows.

    Passed as Arrow data, so that no Python worker is needed to read it.
    """
    target = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = zip(*rows) if rows else [[] for _ in target]
    arrays = [
        pa.array([list(v.items()) if isinstance(v, dict) else v for v in column], type=field.type)
        for column, field in zip(columns, target)
    ]
    return spark.createDataFrame(pa.table(arrays, schema=target), schema=T.StructType.fromDDL(schema))
