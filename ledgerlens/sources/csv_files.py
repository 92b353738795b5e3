"""Records of CSV files whose headers need not agree.

Every file brings its own header: the driver asks Spark for the first record of each file (a job that
reads the start of one file; several run at a time), groups the files by header, and each group is
one scan under its header's names.  So a column goes by its name in *its* file, whatever the order in
the others.  What reaches the driver are file names and headers, no data.

Quotes are those of RFC 4180: a quoted field may hold separators, line ends and doubled quotes.  A
file that may have quoted line ends cannot be split, so a task reads it whole (as a stream);
``quoted_newlines=False`` lets large files without any be split.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that says what is wrong with a record's number of fields.
SHAPE = "_shape"
_RAW = "_record"
#: Headers asked for at a time.
HEADER_JOBS = 16


class MissingColumn(ValueError):
    """A CSV file's header lacks a column of the table."""


def _reader(spark: SparkSession, quoted_newlines: bool):
    # without pruning a record's shape is judged by all its fields, whichever columns a query needs
    return spark.read.options(header=True, quote='"', escape='"', multiLine=quoted_newlines, columnPruning=False)


def _literal(uri: str) -> str:
    """A listed file's address as a path that names that file alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def csv_headers(spark: SparkSession, paths: str | Iterable[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by their header, which is one line."""
    files = sorted(spark.read.text([paths] if isinstance(paths, str) else list(paths)).inputFiles())
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        headers = list(pool.map(lambda f: tuple(c.strip() for c in _reader(spark, False).csv(_literal(f)).columns), files))
    by: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files, strict=True):
        by.setdefault(header, []).append(file)
    return by


def _fields(record: Column) -> Column:
    """Number of fields of a CSV record: commas outside quotes, and one."""
    return F.length(F.regexp_replace(F.regexp_replace(record, '"[^"]*"', ""), "[^,]", "")) + 1


def read_records(spark: SparkSession, paths: str | Iterable[str], columns: Iterable[str], table: str,
                 quoted_newlines: bool = True) -> DataFrame:
    """All records as text columns by name, with ``SHAPE`` saying what is wrong with a record's fields (null: nothing).

    Columns beyond ``columns`` are kept; a file that lacks one of ``columns`` is an error that names both.
    """
    by = csv_headers(spark, paths)
    faults = []
    for header, files in by.items():
        missing = [c for c in columns if c not in header]
        if missing:
            more = f" and {len(files) - 1} more" if len(files) > 1 else ""
            faults.append(f"{files[0]}{more}: {'no header' if not header else 'no column ' + ', '.join(missing)}")
    if faults or not by:
        raise MissingColumn(f"{table}: " + ("; ".join(faults) or "no file"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [_group(spark, header, files, quoted_newlines) for header, files in by.items()])


def _group(spark: SparkSession, header: tuple[str, ...], files: list[str], quoted_newlines: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAW]])
    rows = _reader(spark, quoted_newlines).option("columnNameOfCorruptRecord", _RAW).schema(schema).csv([_literal(f) for f in files])
    n = _fields(F.col(_RAW))
    shape = F.when(n > len(header), "too many fields").when(n < len(header), "too few fields").otherwise("not a record")
    return rows.withColumn(SHAPE, F.when(F.col(_RAW).isNotNull(), shape)).drop(_RAW)
