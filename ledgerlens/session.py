"""Session helpers.  Library functions never create sessions; tests and bench do."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Codec of the Parquet tables written between steps: ids and sentences take about half of what snappy leaves.
COMPRESSION = "zstd"
#: Whether a query that ends removes its shuffle files (Spark 4.1; false by default).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerlens",
                  extra: dict | None = None) -> SparkSession:
    """Local session with the settings the plans are written for (AQE on, UTC, no UI)."""
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the one set on the context.

    A local session without one gets a temporary folder; on a cluster that is an error, since
    every executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder's path under :func:`checkpoint_base`; whoever asked for it removes it (:func:`remove`)."""
    return f"{checkpoint_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block remove their shuffle files when they end; otherwise those stay until the driver collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffles that made it are removed."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever Spark can reach it; an absent one is no error.

    PySpark has no call of its own for this, so it goes through Hadoop's file system.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
