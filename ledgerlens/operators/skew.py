"""Ordered windows over groups of which some hold very many rows.

A window partition is one task.  ``separate`` tells the ordinary groups, whose rows go
straight into a plain window, from the hot ones (more than ``hot_group_rows`` rows), whose
rows get a ``_slice``: a number that grows with the window's order and cuts a group into
pieces of about ``hot_group_rows`` rows.  A window over (group, slice) then handles each
slice in a task of its own, and what the slices before it carry in is joined to it.

Slices follow bounds that are rows of the group itself, chosen by a hash of their order
columns.  So they are a function of the data alone: every use of the sliced rows, on every
attempt of a task and whatever exchanges Spark reuses, sees the same slices.  Groups match
null-safely, and rows of equal order columns share a slice.

Only the list of hot groups is broadcast; it is cut at the ``max_hot_groups`` largest.
Smaller groups beyond that list stay in the plain window, which gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.params import DetectorParams

SLICE = "_slice"


def same(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of all ``keys`` of two frames (the right one's carry a leading ``_k_``)."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def hot_groups(df: DataFrame, keys: Sequence[str], params: DetectorParams) -> DataFrame:
    """Keys of the groups of over ``hot_group_rows`` rows, at most ``max_hot_groups`` of them, largest first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > params.hot_group_rows)
    return counts.orderBy(F.desc("_n"), *keys).limit(params.max_hot_groups).select(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], params: DetectorParams) -> DataFrame | None:
    """:func:`hot_groups` as counted now, a local list of ``max_hot_groups`` rows at most; None without any.

    The count is a job of its own, so that a plan over data without hot groups is the plain one, and
    one over data with some does not count them again for each use.
    """
    found = hot_groups(df, keys, params)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def _bounds_below(bounds: Column, value: Column) -> Column:
    """How many of the sorted ``bounds`` lie below ``value``, by bisection."""
    pair = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(bounds, middle) < value
        return F.when(s["lo"] >= s["hi"], s).when(below, pair(middle + 1, s["hi"])).otherwise(pair(s["lo"], middle))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    return F.aggregate(steps, pair(F.lit(0), F.size(bounds)), halve, lambda s: s["lo"])


def separate(df: DataFrame, keys: Sequence[str], order: Sequence[str], params: DetectorParams) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups with ``_slice``); no second frame without hot groups or where splitting is off."""
    keys, order = list(keys), list(order)
    if not params.split_hot:
        return df, None
    listed = hot_keys(df, keys, params)
    if listed is None:
        return df, None
    hot = F.broadcast(renamed(listed, keys))  # max_hot_groups rows at most
    ordinary = df.join(hot, same(keys, df, hot), "left_anti")
    heavy = df.join(hot, same(keys, df, hot), "left_semi")
    place = F.struct(*order)
    chosen = heavy.filter(F.pmod(F.xxhash64(*order), F.lit(params.hot_group_rows)) == 0)
    bounds = renamed(chosen.groupBy(*keys).agg(F.sort_array(F.collect_set(place)).alias("_bounds")), keys)
    found = heavy.join(bounds, same(keys, heavy, bounds), "left")
    sliced = found.withColumn(SLICE, F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(_bounds_below(F.col("_bounds"), place)))
    return ordinary, sliced.select(*df.columns, SLICE)
