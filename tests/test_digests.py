"""Digest trees and one-scan integrity checks."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import digests as D
from ledgerlens.plans import validation as V
from ledgerlens.session import shared_dir
from tests.conftest import allocations, entries, invoices


def _table(spark, rows, schema="k long, name string, x int"):
    path = shared_dir(spark, "table")
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_equal_tables_need_no_rows(spark):
    rows = [(i, f"n{i}", None) for i in range(3000)] + [(None, None, None)] * 3
    a, b = _table(spark, rows), _table(spark, rows[::-1])
    tree = D.digest_tree(a)
    assert tree.agg(F.sum("rows")).first()[0] == 3003
    assert D.differing_leaves(D.write_tree(a, key=["k"]), D.write_tree(b, key=["k"])) == []
    out = D.digest_diff(a, b, key=["k"])
    assert out.count() == 0 and out.columns == ["side", "k", "name", "x"]
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()


def test_one_changed_row_is_found_in_its_leaf_alone(spark):
    rows = [(i, f"n{i}", None) for i in range(3000)]
    a, b = _table(spark, rows), _table(spark, [*rows[:1234], (1234, "other", None), *rows[1235:]])
    trees = D.write_tree(a, key=["k"]), D.write_tree(b, key=["k"])
    assert len(D.differing_leaves(*trees)) == 1
    assert _rows(D.digest_diff(a, b, key=["k"], trees=trees)) == Counter(
        {("left_only", 1234, "n1234", None): 1, ("right_only", 1234, "other", None): 1})


@pytest.mark.parametrize("key", [None, ["k"], ["k", "name"]])
def test_as_the_plain_difference(spark, key):
    rng = random.Random(5)
    some = lambda: [(rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 1, 2])) for _ in range(400)]
    a, b = _table(spark, some()), _table(spark, some())
    assert _rows(D.digest_diff(a, b, key=key)) == _rows(V.set_diff(a, b)) != Counter()


def test_repeats_nulls_and_empty_tables(spark):
    one, two, none = _table(spark, [(1, "a", 1)]), _table(spark, [(1, "a", 1)] * 2), _table(spark, [])
    assert _rows(D.digest_diff(one, two)) == Counter({("right_only", 1, "a", 1): 1})
    assert _rows(D.digest_diff(none, two)) == Counter({("right_only", 1, "a", 1): 2})
    assert D.digest_diff(none, none).count() == 0
    pair = "a long, b long"
    assert _rows(D.digest_diff(_table(spark, [(1, None)], pair), _table(spark, [(None, 1)], pair), key=["a"])) == Counter(
        {("left_only", 1, None): 1, ("right_only", None, 1): 1})
    with pytest.raises(ValueError, match="different types"):
        D.digest_diff(one, _table(spark, [(1, "a", "1")], "k long, name string, x string"))


def _bronze(spark):
    customers = spark.createDataFrame([("C1",), ("C1",), ("C1",), ("C2",), (None,), (None,)], "customer_id string")
    return {
        "customers": customers,
        "ledger_entries": entries(spark, ("E1", "C1", "payment", 5, "2024-01-01"), ("E1", "C9", "payment", -5, "2024-01-01"),
                                  ("E2", None, "invoice_debit", 5, "2024-01-01"), ("E3", "C9", "credit", None, "2024-01-01")),
        "invoices": invoices(spark, ("I1", "C1", "2024-01-01", "2024-02-01", "2024-03-01", 5), ("I2", "C8", "2024-03-01", "2024-02-01", "2024-03-01", 5)),
        "invoice_allocations": allocations(spark, ("A1", "E1", "I1", 1, "2024-01-01"), ("A1", "E7", "I1", 1, "2024-01-01"),
                                           ("A1", "E7", "I7", 1, "2024-01-01"), (None, None, "I2", 1, "2024-01-01")),
    }


def test_integrity_of_broken_tables(spark):
    got = {r.check_name: r.violations for r in V.bronze_quality_checks(_bronze(spark)).collect()}
    assert got == {"customers_pk_unique": 2, "ledger_pk_unique": 1, "invoices_pk_unique": 0, "allocations_pk_unique": 2,
                   "ledger_customer_fk": 3, "invoice_customer_fk": 1, "allocation_entry_fk": 3, "allocation_invoice_fk": 1,
                   "amount_sign_by_type": 3, "period_start_before_end": 1}


def test_integrity_of_empty_tables(spark):
    got = V.bronze_quality_checks({n: t.limit(0) for n, t in _bronze(spark).items()}).collect()
    assert len(got) == 10 and all(r.violations == 0 for r in got)


def test_integrity_reads_every_table_once(spark):
    tables = {}
    for name, df in _bronze(spark).items():
        path = shared_dir(spark, name)
        df.write.parquet(path)
        tables[name] = spark.read.schema(df.schema).parquet(path)
    plan = V.bronze_quality_checks(tables)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 4 and "Join" not in plan
    assert all(c not in plan for c in ("due_date", "plan_id", "allocated_date"))  # columns pruned


def test_whole_number_keys_match_keys_of_other_widths(spark):
    parents, children = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(2,), (3,), (3,), (None,)], "up long")
    keys, refs = [V.Key("p", "id", "unique")], [V.Reference("c", "up", "p", "orphans")]
    got = {r.check_name: r.violations for r in V.integrity_checks({"p": parents, "c": children}, keys, refs, {}).collect()}
    assert got == {"unique": 0, "orphans": 3}
    got = {r.check_name: r.violations for r in V.integrity_checks({"p": parents, "c": children.select(F.col("up").cast("string"))}, keys, refs, {}).collect()}
    assert got == {"unique": 0, "orphans": 3}
