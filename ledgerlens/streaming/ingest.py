"""Incremental form of the Bronze stage: new CSV files of a table become Bronze rows.

The batch Bronze stage re-reads every input file.  When ledger entries, invoices or
allocations arrive as a steady trickle of files, a file-source stream with
``trigger(availableNow=True)`` ingests only the files not seen before and stops; the
checkpoint (on shared storage) records which files and batches are done, so a lost
executor or a re-run never loads a file twice.

The stream only says which files are new; each micro-batch's files go through the batch
reader, so every file keeps its own header.  Good
rows go to ``<bronze>/batch_id=<n>`` and rejects to ``<rejects>/batch_id=<n>``, both
written with mode overwrite, so a replayed batch replaces its own output: the sink is
idempotent and the ingest exactly-once.  Reading ``<bronze>`` as a table yields all
batches (``batch_id`` becomes a partition column).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.sources.bronze import read_bronze_csv


def ingest_csv_stream(spark: SparkSession, source_dir: str, table: str, bronze_path: str,
                      rejects_path: str, checkpoint: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    """Ingest every new CSV file under ``source_dir`` into the Bronze table ``bronze_path``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arriving = reader.text(source_dir).select("_metadata.file_path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = [unquote(r.file_path) for r in batch.distinct().collect()]  # names only
        if not files:
            return
        good, rejects = read_bronze_csv(spark, files, table)
        good.write.mode("overwrite").format(fmt).save(f"{bronze_path.rstrip('/')}/batch_id={batch_id}")
        rejects.write.mode("overwrite").format(fmt).save(f"{rejects_path.rstrip('/')}/batch_id={batch_id}")

    query = (
        arriving.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
