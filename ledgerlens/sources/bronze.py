"""Bronze sources: typed CSV scan, columnar scan, in-memory rows, upstream checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.sources.csv_files import SHAPE, MissingColumn, read_records
from ledgerlens.sources.versions import load, nothing_there

TABLES = ("customers", "ledger_entries", "invoices", "invoice_allocations")


class UpstreamMissing(RuntimeError):
    """An upstream stage's table is absent; the message is one human-readable line."""


def _try_typed(c: Column, dtype: T.DataType) -> Column:
    """The typed value, or null where the text is no exact value of the type."""
    if isinstance(dtype, T.DateType):
        return F.try_to_date(c, "yyyy-MM-dd")
    if isinstance(dtype, T.DecimalType):  # no silent rounding: one digit more would have to be zero
        wide = c.try_cast(T.DecimalType(38, 18))
        exact = c.try_cast(dtype)
        return F.when(wide == exact, exact)
    return c if isinstance(dtype, T.StringType) else c.try_cast(dtype)


def parse_typed(raw: DataFrame, table: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Text columns of a table (found by name) as ``(typed rows, rejected rows)``.

    A row with a value that is not exactly one of its type is rejected, never dropped or
    rounded: rejects keep the raw text and name the failing columns in ``reject_reason``.
    """
    schema = schema or schemas.BRONZE[table]
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise MissingColumn(f"{table}: the header has no column {', '.join(missing)}")
    failing = [F.when(F.col(f.name).isNotNull() & _try_typed(F.col(f.name), f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    faults = [F.col(SHAPE)] if SHAPE in raw.columns else []
    judged = raw.withColumn("reject_reason", F.concat_ws(",", *faults, *failing)).drop(*faults and [SHAPE])
    good = judged.filter(F.col("reject_reason") == "").select([_try_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    return good, judged.filter(F.col("reject_reason") != "")


def read_bronze_csv(spark: SparkSession, path: str | Iterable[str], table: str, quoted_newlines: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(typed rows, rejected rows)`` of the CSV files under ``path``; columns go by name, file by file.

    Rejects hold records of too few or too many fields and those with values of the wrong type.
    """
    return parse_typed(read_records(spark, path, schemas.BRONZE[table].names, table, quoted_newlines), table)


def read_labels_csv(spark: SparkSession, path: str | Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """``(expected defects, rejected rows)`` of CSV files with the columns of ``schemas.MANIFEST``; an absent invoice is ''."""
    good, rejects = parse_typed(read_records(spark, path, schemas.MANIFEST.names, "labels"), "labels", schemas.MANIFEST)
    return good.fillna("", subset=["affected_invoice_id"]), rejects


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columnar table scan (parquet by default; ``fmt='delta'`` when Delta is installed)."""
    return read_tables(spark, *path.rstrip("/").rsplit("/", 1)[:1], [path.rstrip("/").rsplit("/", 1)[-1]], fmt).popitem()[1]


def require(spark: SparkSession, *paths: str, fmt: str = "parquet") -> list[DataFrame]:
    """Pre-flight check: every path must hold a table (versioned or plain).  Returns the tables; reads no rows.

    Only absence counts as such: a table that is there but cannot be read raises its own error.
    """
    found, absent = [], []
    for path in paths:
        try:
            found.append(load(spark, path, fmt))
        except AnalysisException as e:
            if not nothing_there(e):
                raise
            absent.append(path)
    if absent:
        raise UpstreamMissing(f"no table at {', '.join(absent)}: an earlier stage has not been run")
    return found


def read_tables(spark: SparkSession, base: str, names: Iterable[str] = TABLES,
                fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read a set of tables stored as ``base/<name>``."""
    names = list(names)
    return dict(zip(names, require(spark, *[f"{base.rstrip('/')}/{n}" for n in names], fmt=fmt), strict=True))


def from_rows(spark: SparkSession, rows: Iterable[Mapping] | object, table: str | None = None,
              schema: T.StructType | None = None) -> DataFrame:
    """In-memory source (dict rows or a pandas frame) with an explicit schema.

    ISO date strings and plain numbers are converted to the declared DATE and
    decimal types on the JVM side.
    """
    schema = schema or schemas.BRONZE[table]
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if isinstance(rows, pd.DataFrame):  # column by column, over Arrow
        raw = spark.createDataFrame(rows.reindex(columns=names).astype("string").astype(object).where(rows.reindex(columns=names).notna(), None), text)
    else:
        raw = spark.createDataFrame([tuple(_raw(r.get(n)) for n in names) for r in rows], text)
    return raw.select([_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def _raw(v: object) -> str | None:
    if v is None or (isinstance(v, float) and v != v):
        return None
    return str(v).lower() if isinstance(v, bool) else str(v)


def _typed(c, dtype: T.DataType):
    if isinstance(dtype, T.DateType):
        return F.to_date(c, "yyyy-MM-dd")
    return c.cast(dtype)
