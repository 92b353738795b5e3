"""Global positions without a window over the whole table.

Rows are dealt to ranges of the order and sorted inside each; written like that, a row's place is its
index in its range and the number of rows in the ranges before.  The only thing that leaves the
tasks is one count per range.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import COMPRESSION, shared_dir

_PLACE = "_place"
#: ``monotonically_increasing_id`` holds the partition above its 33 lower bits.
_INDEX_BITS = 33


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's 1-based position in ``order``, which should tell all different rows apart.

    The sorted rows are written to the shared folder once, since the bounds of the ranges come
    from a sample; rows alike in the whole order are of one range.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "ranges")
    (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .withColumn(_PLACE, F.monotonically_increasing_id()).write.option("compression", COMPRESSION).parquet(path))
    rows = spark.read.parquet(path)
    of = F.shiftright(_PLACE, _INDEX_BITS).cast("int")
    sizes = sorted(rows.groupBy(of.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect())  # one number per range
    starts = spark.createDataFrame(list(zip((r.range for r in sizes), accumulate((r.n for r in sizes[:-1]), initial=0), strict=True)) if sizes else [],
                                   "_range int, _before long")
    index = F.col(_PLACE).bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    placed = rows.withColumn("_range", of).join(F.broadcast(starts), "_range")
    return placed.select(*df.columns, (F.col("_before") + index + 1).alias(name))
