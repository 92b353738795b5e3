"""Reading the corpus tables, the folds of labelled rows, and shared intermediate folders."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.text import slices
from ledgerlens.session import remove, shared_dir


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once a session: they need not find it on a path of their own."""
    context = spark.sparkContext
    if context not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "ledgerlens"), "zip", root, "ledgerlens"))
        _SHIPPED.add(context)


_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run(spark, ...)`` after :func:`ship`."""
    @functools.wraps(run)
    def wrapped(spark: SparkSession, *args, **kw) -> DataFrame:
        ship(spark)
        return run(spark, *args, **kw)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id has no fold (null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(folds)


def held_out(doc_id: Column | str, folds: int, out: int) -> Column:
    """True for rows of the held-out fold; a row without id is not held out."""
    return F.coalesce(fold(doc_id, folds) == out, F.lit(False))


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """One row per document: the label where all its rows agree; rows in conflict or without label drop out."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1)).groupBy("doc_id")
            .agg(F.min(name).alias("label"), F.max(name).alias("_most"))
            .filter("label = _most").select("doc_id", "label"))


def lowest_hashed(rows: DataFrame, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows of lowest ``doc_id`` hash: a sample that does not depend on order or partitioning.

    Hashes are uniform, so all but about twice as many rows drop out before anything is sorted.
    """
    share = min(1.0, 2 * most / max(1, rows.count()))
    hashed = rows.withColumn("_h", F.xxhash64("doc_id"))
    near = hashed.filter(F.col("_h") <= int(-(2**63) + share * (2**64 - 1))) if share < 1 else hashed
    return near.orderBy("_h", "doc_id", *ties).limit(most).drop("_h")


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, folds: int, out: int, per_class: int | dict[int, int]) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` labelled documents of either class (or of each) outside the fold."""
    most = per_class if isinstance(per_class, dict) else {0: per_class, 1: per_class}
    y = one_label(labels, name).filter(~held_out("doc_id", folds, out))
    pick = lowest_hashed(y.filter("label = 0"), most[0]).unionByName(lowest_hashed(y.filter("label = 1"), most[1]))
    return _with_text(docs, F.broadcast(pick))


def labelled(docs: DataFrame, labels: DataFrame, name: str, folds: int, out: int) -> DataFrame:
    """(doc_id, label, text) of all labelled documents outside the fold."""
    outside = ~held_out("doc_id", folds, out)
    return _with_text(docs.filter(outside), one_label(labels, name).filter(outside))


def _with_text(docs: DataFrame, y: DataFrame) -> DataFrame:
    text = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    # repeated rows of one id: the least text; copies of one text: the least id, so that copies do not weigh more
    rows = text.join(y, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return rows.groupBy("text", "label").agg(F.min("doc_id").alias("doc_id"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: later reads do not recompute it."""
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def drop(*frames: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more."""
    for frame in frames:
        path = _PATHS.pop(frame, None)
        if path:
            remove(frame.sparkSession, path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def append(docs: DataFrame, measure: Callable[[pa.RecordBatch], list[pa.Array]], fields: T.StructType,
           text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one struct column of ``fields`` that ``measure`` computes from slices of record batches.

    All columns pass through unchanged; the struct's name (returned) clashes with none of them.
    """
    name = fresh("_m", docs.columns)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            made = pa.StructArray.from_arrays(measure(part), names)
            yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])

    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField(name, fields)])
    return docs.mapInArrow(run, schema), name
