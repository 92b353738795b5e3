"""Bronze laid out by customer, once for all operators that go by customer.

Balances, statement sequences and overlaps all window or join by customer.  Read from plain
files each of them shuffles its table by customer again; here the shuffle is done when Bronze is
written: invoices and ledger entries are bucketed tables of the session's catalog, sorted in their
buckets, so windows and joins by customer run without an exchange.

A bucket is one task, so hot customers (over ``hot_group_rows`` rows of either table) do not go into the
buckets.  They are known once the counts are in, and their rows are plain tables beside, on which the
operators split groups as ever (``operators.skew``).  An operator over the layout is its plain plan
over the buckets and, only where there are hot customers, the splitting plan over theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.skew import hot_keys, renamed, same
from ledgerlens.params import DetectorParams
from ledgerlens.session import COMPRESSION, remove, shared_dir, shuffles_freed

#: Order of the rows in a bucket, which is that of the operators' windows.
SORTED = {"ledger_entries": ("customer_id", "effective_date", "entry_id"),
          "invoices": ("customer_id", "statement_period_start", "invoice_id")}


@dataclass
class CustomerLayout:
    """Tables by customer: bucketed ones, and those of hot customers (None without any).  Other tables are the same in both."""

    spark: SparkSession
    ordinary: dict[str, DataFrame]
    hot: dict[str, DataFrame] | None
    names: list[str]
    paths: list[str]

    def each(self, operator: Callable[[dict[str, DataFrame], DetectorParams], DataFrame], params: DetectorParams) -> DataFrame:
        """The rows of an operator that goes by customer, over all customers."""
        plain = operator(self.ordinary, params.with_(split_hot=False))
        return plain if self.hot is None else plain.unionByName(operator(self.hot, params))

    def whole(self, table: str) -> DataFrame:
        """All rows of a table."""
        return self.ordinary[table] if self.hot is None else self.ordinary[table].unionByName(self.hot[table])

    def drop(self) -> None:
        """Remove the tables."""
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")
        for path in self.paths:
            remove(self.spark, path)


def write_layout(spark: SparkSession, tables: dict[str, DataFrame], params: DetectorParams, buckets: int | None = None,
                 names: Sequence[str] = tuple(SORTED)) -> CustomerLayout:
    """Write the tables of ``SORTED``, or those of ``names``, by customer, in ``buckets`` files each (the session's shuffle partitions by default).

    Choose ``buckets`` so that one holds some hundred MB; it stays with the tables.  The shuffles that write them are
    removed as soon as they are written.
    """
    with shuffles_freed(spark):
        return _written(spark, tables, params, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), names)


def _written(spark: SparkSession, tables: dict[str, DataFrame], params: DetectorParams, buckets: int, names: Sequence[str]) -> CustomerLayout:
    run = uuid.uuid4().hex[:12]
    keys = [hot_keys(tables[name], ["customer_id"], params) for name in names] if params.split_hot else []
    found = [k for k in keys if k is not None]
    hot = found[0].union(*found[1:]).distinct() if len(found) > 1 else found[0] if found else None
    layout = CustomerLayout(spark, dict(tables), dict(tables) if hot is not None else None, [], [])
    for name in names:
        rows, order = tables[name], SORTED[name]
        if hot is not None:
            listed = F.broadcast(renamed(hot, ["customer_id"]))  # max_hot_groups a table at most
            path = shared_dir(spark, f"hot-{name}")
            rows.join(listed, same(["customer_id"], rows, listed), "left_semi").write.option("compression", COMPRESSION).parquet(path)
            layout.hot[name] = spark.read.schema(rows.schema).parquet(path)
            layout.paths.append(path)
            rows = rows.join(listed, same(["customer_id"], rows, listed), "left_anti")
        path, table = shared_dir(spark, f"by-customer-{name}"), f"ledgerlens_{name}_{run}"
        # dealt as the buckets are, so every bucket is one file
        (rows.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy(*order).option("compression", COMPRESSION).option("path", path).saveAsTable(table))
        layout.names.append(table)
        layout.paths.append(path)
        layout.ordinary[name] = spark.table(table)
    return layout
