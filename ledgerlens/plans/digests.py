"""Tables compared by digests: a tree of buckets, of which only those that differ are read in full.

A row belongs to the leaf that the hash of its key columns gives; a leaf's digest is its number
of rows and two sums of differently seeded 64-bit row hashes, so the order of rows does not matter and repeated
rows count.  ``FAN`` leaves make a branch, whose digest is the sum over its leaves.  Two trees are compared
branch by branch first, then by the leaves of branches that differ; the rows of these leaves alone
are compared themselves.  A tree is a table of at most ``FAN * FAN`` rows, kept beside its table or made anew.

Nulls are values like others here (a null equals a null).  Equal digests of different rows need both sums
to agree by chance, about 1 in 2^128 for a pair of leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans.validation import set_diff
from ledgerlens.session import shared_dir

#: Leaves of a branch, and branches of a tree; a list of leaves or branches on the driver is bounded by its square.
FAN = 256
_SUMS = ("rows", "sum_a", "sum_b")


def _marked(c: str) -> list[Column]:
    """A column and whether it is null: hashes alone pass over nulls, so that (1, null) would equal (null, 1)."""
    col = F.col(f"`{c}`")
    return [col, col.isNull()]


def _leaf(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[x for c in key for x in _marked(c)]), F.lit(FAN * FAN)).cast("int")


def digest_tree(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(branch, leaf, rows, sum_a, sum_b) of the leaves of ``df`` that hold rows; one pass, partial sums before the shuffle."""
    values = [x for c in df.columns for x in _marked(c)]
    hashed = df.select(_leaf(key or df.columns).alias("leaf"), F.xxhash64(F.lit(1), *values).cast("decimal(20,0)").alias("a"),
                       F.xxhash64(F.lit(2), *reversed(values)).cast("decimal(20,0)").alias("b"))
    leaves = hashed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))
    return leaves.select((F.col("leaf") / FAN).cast("int").alias("branch"), "leaf", *_SUMS)


def write_tree(df: DataFrame, path: str | None = None, key: list[str] | None = None) -> DataFrame:
    """The digest tree of ``df`` written at ``path`` (else under ``spark.checkpoint.dir``) and read back."""
    spark = df.sparkSession
    path = path or shared_dir(spark, "digests")
    tree = digest_tree(df, key)
    tree.write.mode("overwrite").parquet(path)
    return spark.read.schema(tree.schema).parquet(path)


def _differing(left: DataFrame, right: DataFrame, level: str) -> list[int]:
    """Nodes of a level whose digests differ, or that one side lacks."""
    sums = lambda df, sign: df.select(level, *[(F.col(c) * sign).alias(c) for c in _SUMS])
    net = sums(left, 1).unionByName(sums(right, -1)).groupBy(level).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return sorted(r[0] for r in net.filter(" or ".join(f"{c} <> 0" for c in _SUMS)).select(level).collect())


def differing_leaves(left: DataFrame, right: DataFrame) -> list[int]:
    """Leaves in which two written trees differ, found branch by branch; at most ``FAN * FAN`` numbers."""
    branches = _differing(left, right, "branch")
    if not branches:
        return []
    some = F.col("branch").isin(branches)
    return _differing(left.filter(some), right.filter(some), "leaf")


def digest_diff(left: DataFrame, right: DataFrame, key: list[str] | None = None, left_name: str = "left_only", right_name: str = "right_only",
                trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The multiset difference of two tables of the same columns, as :func:`set_diff` gives it, by their digest trees.

    ``trees`` are kept trees of the two, made with the same ``key``.  Rows outside the leaves that differ are read once, for
    their digest, or not at all with kept trees; equal tables give an empty result without a second look.
    """
    right = right.select(*left.columns)
    if left.dtypes != right.dtypes:
        raise ValueError(f"columns of different types: {left.dtypes} and {right.dtypes}")
    leaves = differing_leaves(*(trees or (write_tree(left, key=key), write_tree(right, key=key))))
    if not leaves:
        spark = left.sparkSession
        return set_diff(spark.createDataFrame([], left.schema), spark.createDataFrame([], right.schema), left_name, right_name)
    spark = left.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(x,) for x in leaves], "_leaf int"))  # FAN * FAN rows at most
    # where the trees differ widely the list prunes nothing, but stays right
    rows = lambda df: df.withColumn("_leaf", _leaf(key or left.columns)).join(wanted, "_leaf", "left_semi").drop("_leaf")
    return set_diff(rows(left), rows(right), left_name, right_name)
