"""Corpus pipeline: quality rules and classifier, near-dedup, decontamination, tokenisation.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the
columns of ``docs``; the last returns the tokenised documents.  ``run`` writes each stage's
rows as Parquet in the shared folder and reads them again for the next, so a lost executor
never costs more than one stage.

A session's executors run all stages, and neither Java nor Python gives much memory back, so
stages ask for record batches of ``BATCH_ROWS`` rows at most: the session's setting, which stays.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, decontam, minhash, quality_model, quality_rules
from ledgerlens.llm.corpus import shipped, table, written

BATCH_ROWS = 2000


def lean(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` with record batches of ``BATCH_ROWS`` rows, or of fewer if the session asks for fewer."""
    @functools.wraps(stage)
    def wrapped(spark: SparkSession, *args, **kw) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:  # 0 or less: no limit
            spark.conf.set(name, BATCH_ROWS)
        return shipped(stage)(spark, *args, **kw)

    return wrapped


STAGES = [
    ("quality_rules", lean(quality_rules.stage)),
    ("quality_model", lean(quality_model.stage)),
    ("near_dedup", lean(minhash.stage)),
    ("decontamination", lean(decontam.stage)),
    ("byte_bpe", lean(bpe.stage)),
]

#: The classifier is trained by gradient descent, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
