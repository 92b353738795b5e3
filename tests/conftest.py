import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.bronze import from_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app="ledgerlens-tests")
    yield s
    s.stop()


ENT = ["entry_id", "customer_id", "type", "amount", "effective_date", "source", "status"]


def entries(spark, *rows):
    """Ledger rows as tuples (entry_id, customer_id, type, amount, date[, status])."""
    out = []
    for r in rows:
        eid, cust, typ, amt, d = r[:5]
        status = r[5] if len(r) > 5 else "settled"
        out.append(dict(entry_id=eid, customer_id=cust, type=typ, amount=amt, effective_date=d,
                        source="x", status=status))
    return from_rows(spark, out, "ledger_entries")


def invoices(spark, *rows):
    """Invoice rows (invoice_id, customer_id, ps, pe, due, amount)."""
    out = [dict(invoice_id=i, customer_id=c, statement_period_start=ps, statement_period_end=pe,
                due_date=due, amount_due=amt, issued_date=ps) for i, c, ps, pe, due, amt in rows]
    return from_rows(spark, out, "invoices")


def allocations(spark, *rows):
    """Allocation rows (allocation_id, entry_id, invoice_id, amount, date)."""
    out = [dict(allocation_id=a, entry_id=e, invoice_id=i, amount_allocated=amt, allocated_date=d)
           for a, e, i, amt, d in rows]
    return from_rows(spark, out, "invoice_allocations")
