"""Guards on the physical plans: the shapes that keep the detector scalable."""
import os

import pytest

import __spark_entry__ as E
from ledgerlens.operators.intervals import overlap_pairs
from ledgerlens.params import TESTDATA_PARAMS
from ledgerlens.sources.testdata import billing_tables

SF = "/root/testdata/sf0.001"
assert os.path.isdir(SF), "the test tables are missing"

# Side effects (writes) or eager checkpoints at build time: not needed for plan checks.
SKIP = {"medallion_roundtrip", "silver_notices", "silver_running_balance", "bronze_csv_roundtrip", "bronze_csv_two_headers", "detection_scorecard",
        "missed_defects", "false_positives", "severity_confusion", "silver_invoices", "silver_end_of_day", "stage_metrics",
        "report_flags_by_rule", "report_flags_by_month", "report_severity_matrix", "report_flag_drilldown", "table_diff_by_digest"}
# The corpus queries have tests of their own.
CORPUS = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP - CORPUS))
def test_no_cartesian_nested_loop_or_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_rule5_joins_on_customer_time_bin_and_amount_band(spark):
    df = overlap_pairs(billing_tables(spark, SF)["invoices"], TESTDATA_PARAMS.with_(pairwise_rows=1))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert any("a_bin" in j and "a_band" in j and "a_customer_id" in j and "a_part" in j for j in joins)
    assert all("a_customer_id" in j or "_customer_id" in j for j in joins)  # customers of few statements meet by customer alone


@pytest.mark.parametrize("name", ["running_balance", "end_of_day", "continuity", "rule3", "rule5"])
def test_no_exchange_by_customer_over_bronze_laid_out_by_customer(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        plan = _plan(E.queries()[f"bucketed_{name}"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "Bucketed: true" in plan
    assert not [x for x in exchanges if x.split("hashpartitioning(")[1].startswith("customer_id") and x.count("#") <= 3]
    if name in ("continuity", "rule3", "rule5"):
        assert not exchanges


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _plan(E.queries()["dishonoured_entries"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("l_comment" not in s and "l_tax" not in s for s in scans)
    assert any("PushedFilters: [IsNotNull(l_orderkey)" in s for s in scans)


def test_gold_assembly_computes_the_shared_balance_lookup_once(spark):
    from ledgerlens.params import TESTDATA_PARAMS
    from ledgerlens.plans.flags import flagged_accounts
    from ledgerlens.sources.testdata import billing_tables

    df = flagged_accounts(billing_tables(spark, SF), TESTDATA_PARAMS)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    # Rules 1 and 4 join back to the same lookup: its exchange runs once and is reused.
    assert "ReusedExchange [_bc" in final


def _exchanges(spark, df) -> list[str]:
    """Keys of the shuffles of a plan in which nothing is broadcast unasked."""
    return [line.split("hashpartitioning(")[1].split("#")[0] for line in _plan(df).splitlines() if "Exchange hashpartitioning" in line]


def test_days_are_added_up_and_windowed_in_one_shuffle(spark):
    from ledgerlens.operators import allocations as A
    from ledgerlens.operators import ledger as L

    t = {n: df.localCheckpoint() for n, df in billing_tables(spark, SF).items()}
    entries, invoices = t["ledger_entries"], t["invoices"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(spark, L.end_of_day_balance(entries)) == ["customer_id"]
        targets = invoices.selectExpr("customer_id", "due_date as date")
        assert _exchanges(spark, L.balance_asof(targets, L.entry_amounts(entries))) == ["customer_id"]
        assert _exchanges(spark, A.allocated_at_sent(invoices, t["invoice_allocations"], TESTDATA_PARAMS)) == ["invoice_id"] * 2  # one of either table
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_reads_amounts_and_dishonoured_days_in_one_scan(spark):
    from ledgerlens.operators import ledger as L
    from tests.conftest import entries

    rows = entries(spark, ("e1", "c", "payment", 10, "2024-01-01"), ("e2", "c", "payment", 7, "2024-01-03", "dishonoured"),
                   ("e3", "c", "payment", 5, "2024-01-04", None), ("e4", "d", "payment", 3, "2024-01-02", "dishonoured"),
                   ("e5", "c", "payment", 4, None, "dishonoured"), ("e6", None, "payment", 4, "2024-01-03", "dishonoured"),
                   ("e7", "c", "payment", 2, "2024-01-03"))
    none = rows.selectExpr("customer_id", "effective_date as date").limit(0)
    apart = L.balance_lookup(L.entry_amounts(rows), [(L.dishonoured_entries(rows), "effective_date")]).filter("customer_id is not null")
    together = L.balance_lookup(L.entry_movements(rows), [(none, "date")])
    assert sorted(map(tuple, together.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)
    assert together.count() == 2
