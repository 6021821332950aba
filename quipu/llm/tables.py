"""Reading the given tables, and tables written for co-located joins."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quipu.session import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``key``, so that joins on it need no shuffle of it.

    Spark allows a session a highest number of buckets; beyond it buckets get larger, and what
    is grouped by ``key`` within them is sorted and spilled as any group is.  The catalog only
    lends its name while the table is written and found; nothing stays in it.
    """
    spark = df.sparkSession
    name = f"quipu_{label}_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    df.write.format("parquet").bucketBy(max(1, min(buckets, most)), key).option("path", new_path(spark, label)).saveAsTable(name)
    found = spark.table(name)
    found.schema  # the files and buckets are known now
    spark.sql(f"DROP TABLE {name}")
    return found


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="quipu-package-")) / "quipu.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted((root / "quipu").rglob("*.py")):
            packed.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
