"""Balances, the as-of lookup, totals at the sent date, notices: own small ledgers."""
import datetime as dt
from decimal import Decimal

import pytest

from ledgerlens.operators import allocations as A
from ledgerlens.operators import ledger as L
from ledgerlens.operators import notices as N
from ledgerlens.params import DetectorParams
from tests.conftest import allocations, entries, invoices

P = DetectorParams()


@pytest.fixture(scope="module")
def book(spark):
    """Two customers and a nameless one; same-day entries, a dishonoured one, one without status."""
    return entries(
        spark, ("k3", "N1", "payment", "8.25", "2023-09-04"), ("k1", "N1", "invoice_debit", "-20.00", "2023-09-04"),
        ("k2", "N1", "credit", "3.00", "2023-09-01"), ("k4", "N1", "payment", "99.00", "2023-09-05", "dishonoured"),
        ("k5", "N1", "payment", "7.00", "2023-09-06", None), ("k6", "N1", "payment", "10.00", "2023-09-09"),
        ("m1", "N2", "payment", "1.50", "2023-09-04"), ("z1", None, "payment", "1000.00", "2023-09-01"))


@pytest.mark.parametrize("params", [P, P.with_(split_hot=False), P.with_(hot_group_rows=1)])
def test_running_balance(book, params):
    got = {r.entry_id: str(r.running_balance) for r in L.running_balance(book, params).collect()}
    assert got == {"k2": "3.00", "k1": "-17.00", "k3": "-8.75", "k6": "1.25", "m1": "1.50", "z1": "1000.00"}


def test_account_views(book):
    days = {(r.customer_id, str(r.effective_date)): (r.day_amount, r.balance) for r in L.end_of_day_balance(book).collect() if r.customer_id == "N1"}
    assert days == {("N1", "2023-09-01"): (3, 3), ("N1", "2023-09-04"): (Decimal("-11.75"), Decimal("-8.75")),
                    ("N1", "2023-09-09"): (10, Decimal("1.25"))}
    assert {r.customer_id: str(r.last_entry_date) for r in L.overpaid_accounts(book).collect()} == {
        "N1": "2023-09-09", "N2": "2023-09-04", None: "2023-09-01"}
    assert [r.entry_id for r in L.dishonoured_entries(book).collect()] == ["k4"]


@pytest.mark.parametrize("amounts", [L.entry_amounts, lambda e: L.day_amounts(L.end_of_day_balance(e))])
def test_balance_asof(spark, book, amounts):
    day = lambda d: dt.date(2023, 9, d)
    asked = [("N1", dt.date(2023, 8, 31)), ("N1", day(4)), ("N1", day(4)), ("N1", day(7)), ("N2", day(30)), ("N9", day(30)), (None, day(30)), ("N1", None)]
    t = spark.createDataFrame(asked, "customer_id string, date date")
    rows = L.balance_asof(t, amounts(book)).collect()
    assert {(r.customer_id, r.date): None if r.running_balance is None else str(r.running_balance) for r in rows} == {
        ("N1", dt.date(2023, 8, 31)): None, ("N1", day(4)): "-8.75", ("N1", day(7)): "-8.75", ("N2", day(30)): "1.50",
        ("N9", day(30)): None, (None, day(30)): None}
    assert len(rows) == 6


@pytest.mark.parametrize(("when", "total"), [("2023-11-21", "12.00"), ("2023-11-22", "0"), (None, "0")])
def test_allocations_count_up_to_the_sent_date(spark, when, total):
    inv = invoices(spark, ("90", "N1", "2023-10-01", "2023-10-31", "2023-11-14", "12.00"))
    al = allocations(spark, ("u1", "k6", "90", "12.00", when), ("u2", "k6", "91", "50", "2023-01-01"))
    (r,) = A.allocated_at_sent(inv, al, P).collect()
    assert (str(r.sent_date), r.allocated_total_at_sent) == ("2023-11-21", Decimal(total))
    assert N.under_allocated(inv, al, P).count() == (total == "0")


def test_notices_and_their_views(spark, book):
    inv = invoices(spark, ("92", "N1", "2023-08-01", "2023-08-31", "2023-08-28", 40), ("93", "N1", "2023-08-01", "2023-08-31", "2023-09-03", 40),
                   ("94", "N9", "2023-08-01", "2023-08-31", "2023-09-03", 40), ("95", "N1", "2023-08-01", "2023-08-31", "2023-08-28", 40))
    al = allocations(spark, ("u1", "k6", "95", "39.99", "2023-08-30"), ("u2", "k6", "95", "0.01", "2023-09-04"), ("u3", "k6", "93", "15", "2023-09-01"))
    sent = N.naive_notices(inv, al, book, P)
    got = {r.invoice_id: (str(r.sent_date), r.balance_at_sent, r.in_credit) for r in sent.collect()}
    assert got == {"92": ("2023-09-04", Decimal("-8.75"), False), "93": ("2023-09-10", Decimal("1.25"), True), "94": ("2023-09-10", 0, True)}
    silver = N.notices_of(A.allocated_at_sent(inv, al, P), L.day_amounts(L.end_of_day_balance(book)))
    assert sorted(map(tuple, silver.collect())) == sorted(map(tuple, sent.collect()))
    assert {r.invoice_id: r.notice_class for r in N.notice_classes(sent).collect()} == {"92": "legitimate", "93": "wrongful", "94": "wrongful"}
    assert {r.invoice_id: r.allocation_shortfall for r in N.reconciliation_mismatch(sent).collect()} == {"93": 25, "94": 40}
    place = {r.invoice_id: (r.allocated_total, r.allocated_total_at_sent, r.balance_at_due, r.notice_sent)
             for r in N.invoice_position(inv, al, book, P).collect()}
    assert place["95"] == (40, 40, 0, False) and place["93"] == (15, 15, 3, True)
