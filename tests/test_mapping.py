"""Declared mappings of star schemas: checks before any row is read, types, lookups, filters, plans."""
import datetime
from dataclasses import replace
from decimal import Decimal

import pytest

from ledgerlens import schemas
from ledgerlens.sources.mapping import Lookup, MappingError, Rows, StarMapping
from ledgerlens.sources.testdata import ORDERS, READ_SCHEMAS, SUPPLIES

BILL = Rows("bill", {
    "invoice_id": "concat('I', no)", "customer_id": "account", "statement_period_start": "opened", "statement_period_end": "date_add(opened, 30)",
    "due_date": "date_add(opened, 30 + days)", "amount_due": "cast(total as decimal(18,2))", "issued_date": "null"},
    lookups=(Lookup("terms", "bill.term = terms.term", "left"),), where="total > 0")
PAID = Rows("bill", {
    "entry_id": "concat('P', no)", "customer_id": "account", "type": "'payment'", "amount": "cast(total as decimal(18,2))",
    "effective_date": "opened", "source": "'x'", "status": "'settled'"})
NOTHING = Rows("bill", {f.name: "null" for f in schemas.INVOICE_ALLOCATIONS.fields}, where="false")
PEOPLE = Rows("bill", {"customer_id": "account", "plan_id": "terms.label", "signup_date": "null", "status": "'active'"},
              lookups=(Lookup("terms", "bill.term <=> terms.term"),))
SMALL = StarMapping({"customers": (PEOPLE,), "invoices": (BILL,), "ledger_entries": (PAID, replace(PAID, columns=PAID.columns | {
    "entry_id": "concat('Q', no)", "amount": "-1"})), "invoice_allocations": (NOTHING,)})


@pytest.fixture(scope="module")
def sources(spark):
    day = datetime.date(2024, 1, 31)
    bill = [(1, 10, "a", 12.34, day, "clash"), (2, 10, None, 5.0, day, None), (3, None, "zz", 7.0, None, ""), (4, 11, "a", -1.0, day, "x")]
    return {
        "bill": spark.createDataFrame(bill, "no int, account long, term string, total double, opened date, label string"),
        "terms": spark.createDataFrame([("a", 5, "five"), (None, 9, "none")], "term string, days int, label string"),
        "unused": spark.range(1),
    }


def faults(sources, **targets):
    with pytest.raises(MappingError) as e:
        replace(SMALL, targets={**SMALL.targets, **targets}).tables(sources)
    assert all(f in str(e.value) for f in e.value.faults)
    return e.value.faults


def test_rows_types_and_lookups(sources):
    t = SMALL.tables(sources)
    assert {n: df.schema.simpleString() for n, df in t.items()} == {n: s.simpleString() for n, s in schemas.BRONZE.items()}
    found = {r.invoice_id: r for r in t["invoices"].collect()}
    day = datetime.date(2024, 1, 31)
    assert set(found) == {"I1", "I2", "I3"}  # the filter; a left lookup that finds nothing keeps its row
    assert found["I1"].due_date == day + datetime.timedelta(35) and found["I1"].amount_due == Decimal("12.34")
    assert found["I2"].due_date is None and found["I3"].customer_id is None and found["I3"].statement_period_end is None
    people = sorted((r.customer_id, r.plan_id) for r in t["customers"].collect())
    assert people == [("10", "five"), ("10", "none"), ("11", "five")]  # an inner one drops it; equal names by their table
    assert sorted(r.entry_id for r in t["ledger_entries"].collect()) == [f"{x}{i}" for x in "PQ" for i in range(1, 5)]
    assert {r.amount for r in t["ledger_entries"].filter("entry_id like 'Q%'").collect()} == {Decimal("-1.00")}
    assert t["invoice_allocations"].collect() == []
    assert SMALL.sources() == ["bill", "terms"]
    kept = replace(SMALL, types={"customer_id": "bigint"}).tables(sources)
    assert dict(kept["invoices"].dtypes)["customer_id"] == dict(kept["customers"].dtypes)["customer_id"] == "bigint"
    empty = SMALL.tables({n: df.limit(0) for n, df in sources.items()})
    assert all(df.collect() == [] for df in empty.values())


def test_every_fault_is_named_at_once(sources):
    wrong = BILL.columns | {"amount_due": "total", "due_date": "due_on", "issued_date": "date_add(", "statement_period_end": "to_timestamp(opened)"}
    found = faults(sources, invoices=(replace(BILL, columns=wrong),), customers=())
    assert "no rows for customers" in found
    # expressions that do not resolve come first; types are judged once all do
    assert [f.split(":")[0] for f in found[1:]] == ["invoices[0].due_date", "invoices[0].issued_date"] and "due_on" in found[1]
    found = faults(sources, invoices=(BILL, replace(BILL, columns=BILL.columns | {"amount_due": "total", "statement_period_end": "to_timestamp(opened)"})))
    assert [f.split(" is not")[0] for f in found] == ["invoices[1].statement_period_end: timestamp", "invoices[1].amount_due: double"]


@pytest.mark.parametrize("rows, fault", [
    (replace(BILL, source="bills"), "invoices[0]: no source table bills"),
    (replace(BILL, lookups=(Lookup("term", "true"),)), "invoices[0]: no source table term"),
    (replace(BILL, lookups=(Lookup("terms", "true", "cross"),)), "invoices[0]: a lookup is inner or left, not cross"),
    (replace(BILL, columns={**BILL.columns, "due": "null"}), "invoices[0]: invoices has no column due"),
    (replace(BILL, columns={c: e for c, e in BILL.columns.items() if c != "due_date"}), "invoices[0]: no expression for due_date"),
    (replace(BILL, where="totals > 0"), "invoices[0]: where: "),
    (replace(BILL, lookups=(Lookup("terms", "term = days"),)), "invoices[0]: lookup of terms: "),
    (replace(BILL, columns={**BILL.columns, "customer_id": "label"}), "invoices[0].customer_id: "),  # both tables have it
    (replace(BILL, columns={**BILL.columns, "amount_due": "sum(days)"}), "invoices[0]: its expressions cannot stand in one row"),
])
def test_a_fault(sources, rows, fault):
    found = faults(sources, invoices=(rows,))
    assert len(found) == 1 and found[0].startswith(fault)


def test_unknown_tables_and_types(sources):
    assert faults(sources, payments=(BILL,)) == ["no billing table payments"]
    with pytest.raises(MappingError, match="no billing table has a column invoice"):
        replace(SMALL, types={"invoice": "bigint"}).tables(sources)
    with pytest.raises(MappingError, match="string is not kept whole as bigint"):
        replace(SMALL, types={"invoice_id": "bigint"}).tables(sources)


@pytest.mark.parametrize("star", [ORDERS, SUPPLIES])
def test_scans_of_the_test_mappings_stay_pruned(spark, star):
    sf = "/root/testdata/sf0.001"
    t = star.tables({n: spark.read.schema(READ_SCHEMAS[n]).parquet(f"{sf}/{n}.parquet") for n in star.sources()})
    plan = t["invoices"].select("due_date")._jdf.queryExecution().executedPlan().toString()
    assert "price" not in plan and "l_discount" not in plan
    plan = t["invoice_allocations"]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(l_returnflag,A)" in plan and "Exchange" not in plan
