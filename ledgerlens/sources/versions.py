"""Tables written as versions, committed by one small record.

A table's folder holds a folder per version and ``_log``, a table of commits.  A write first puts
the rows into a version folder that nobody reads yet, then appends one record to the log; readers
take the version of the latest record.  So there is always a whole table: a write that stops in
between leaves the one before, and nothing is renamed or deleted on the way, which would be a copy on
an object store.  Versions before the latest are kept for readers that began with them until
:func:`vacuum` removes them.

The record also holds what was observed while the rows went by (``rows`` and any other
aggregate), so counting a table that was just written takes no further job.

Formats with a log of their own (``delta``) are overwritten in their own way.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import COMPRESSION, remove

LOG = "_log"
LOG_SCHEMA = "sequence long, version string, metrics map<string, long>, committed timestamp"
_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def nothing_there(e: AnalysisException) -> bool:
    """Whether the error says that nothing is there (rather than that it cannot be read)."""
    return (e.getCondition() or "").startswith(_ABSENT)


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """The log of a versioned table (``LOG_SCHEMA``); None where there is none."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{path.rstrip('/')}/{LOG}")
    except AnalysisException as e:
        if not nothing_there(e):
            raise
        return None


def latest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(sequence, version) of the latest commit; of several at one sequence the greatest version."""
    log = commits(spark, path)
    found = log.agg(F.max(F.struct("sequence", "version")).alias("top")).first() if log is not None else None
    return (found.top.sequence, found.top.version) if found and found.top else None


def stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
          metrics: Mapping[str, Column] | None = None) -> tuple[str, dict[str, int]]:
    """Write ``df`` as a version that nobody reads yet: (its name, what was observed)."""
    version = f"v-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **(metrics or {})}
    writer = df.observe(seen, *[c.cast("long").alias(n) for n, c in wanted.items()]).write.format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(f"{path.rstrip('/')}/{version}")
    return version, {n: int(v or 0) for n, v in seen.get.items()}


def publish(spark: SparkSession, path: str, version: str, metrics: Mapping[str, int]) -> None:
    """Make a staged version the table: one record appended to the log."""
    last = latest(spark, path)
    record = spark.createDataFrame([((last[0] if last else 0) + 1, version, dict(metrics))], "sequence long, version string, metrics map<string, long>")
    record.coalesce(1).withColumn("committed", F.current_timestamp()).write.mode("append").parquet(f"{path.rstrip('/')}/{LOG}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Replace the table at ``path`` by ``df``; returns the observed ``metrics`` and ``rows``."""
    if fmt == "delta":
        writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", True)
        (writer.partitionBy(partition_by) if partition_by else writer).save(path)
        return {}
    version, seen = stage(df, path, fmt, partition_by, metrics)
    publish(df.sparkSession, path, version, seen)
    return seen


def load(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The latest version of a versioned table, else the plain table at ``path``."""
    last = latest(spark, path)
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{last[1]}" if last else path)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the versions committed before the latest ``keep``; returns their names.

    A version that was never committed has no record and may still be being written: it stays.
    """
    log = commits(spark, path)
    old = [] if log is None else [r.version for r in log.orderBy(F.desc("sequence"), F.desc("version")).offset(keep).collect()]
    for version in old:
        remove(spark, f"{path.rstrip('/')}/{version}")
    return old
