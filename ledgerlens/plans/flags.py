"""Silver and Gold assembly over the four billing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from ledgerlens.operators import allocations as A
from ledgerlens.operators import ledger as L
from ledgerlens.operators import notices as N
from ledgerlens.operators import rules as R
from ledgerlens.params import DetectorParams
from ledgerlens.session import written
from ledgerlens.sources.layout import CustomerLayout, write_layout


def build_silver(tables: dict[str, DataFrame], params: DetectorParams = DetectorParams()) -> dict[str, DataFrame]:
    """The Silver tables that come from Bronze alone: balances per entry and per day, invoices at their sent date."""
    inv, alloc, ent = tables["invoices"], tables["invoice_allocations"], tables["ledger_entries"]
    return {
        "silver_running_balance": L.running_balance(ent, params),
        "silver_end_of_day": L.end_of_day_balance(ent),
        "silver_invoices": A.allocated_at_sent(inv, alloc, params),
    }


def gold_frames(tables: dict[str, DataFrame], params: DetectorParams = DetectorParams(),
                silver: dict[str, DataFrame] | None = None, asof: Column | None = None,
                layout: CustomerLayout | None = None) -> dict[int, DataFrame]:
    """The five rule outputs, keyed by rule id (each in the common schema).

    ``asof`` is rule 2's date where ``tables`` do not hold all invoices.  With ``layout``, rules 3 and 5 read the
    invoices as laid out by customer, and the notices' invoices, which two shuffles find and rules 1 and 4 read, are written.

    With ``silver`` (as written by the medallion stage) rules 1 and 4 read its notices and
    end-of-day balances; without it one as-of lookup over one allocated-at-sent table serves both.
    """
    inv, alloc, ent = tables["invoices"], tables["invoice_allocations"], tables["ledger_entries"]
    of_invoices = lambda rule: rule(inv, params) if layout is None else layout.each(lambda t, p: rule(t["invoices"], p), params)
    if silver is not None:
        notices, lookup, amounts = silver["silver_notices"], None, L.day_amounts(silver["silver_end_of_day"])
    else:
        under, amounts = N.under_allocated(inv, alloc, params), L.entry_amounts(ent)
        under = under if layout is None else written(under, "under-allocated")
        # the days of dishonoured entries come with the amounts, from the same scan
        lookup = L.balance_lookup(L.entry_movements(ent), [(under, "sent_date")])
        notices = N.notices_of(under, amounts, lookup)
    return {
        1: R.rule1_wrongful_notice(notices, params),
        2: R.rule2_orphaned_credit(ent, alloc, inv, params, asof),
        3: of_invoices(R.rule3_statement_gap),
        4: R.rule4_dishonour(ent, params, lookup, amounts),
        5: of_invoices(R.rule5_duplicate_invoice),
    }


def flagged_accounts(tables: dict[str, DataFrame], params: DetectorParams = DetectorParams(),
                     silver: dict[str, DataFrame] | None = None, asof: Column | None = None) -> DataFrame:
    """The Gold table: union by name of the five rules, one row per anomaly instance."""
    return _union(gold_frames(tables, params, silver, asof))


def _union(frames: dict[int, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames.values())


def flagged_by_layout(layout: CustomerLayout, params: DetectorParams = DetectorParams()) -> DataFrame:
    """The Gold table over Bronze laid out by customer: all rules go by customer but for the latest due date."""
    asof = R.asof_date(layout.whole("invoices"))
    return layout.each(lambda tables, p: flagged_accounts(tables, p, asof=asof), params)


def flagged_over_lookups(tables: dict[str, DataFrame], params: DetectorParams = DetectorParams()) -> DataFrame:
    """The Gold table where invoices are looked up row by row in large tables: that is done once.

    The invoices are written by customer, for rules 3 and 5 as they lie, and read back by the others; each reader would
    otherwise shuffle the source by the lookup's key again.  No rule reads the date of issue.
    """
    invoices = tables["invoices"].drop("issued_date")
    layout = write_layout(invoices.sparkSession, {"invoices": invoices}, params, names=["invoices"])
    return _union(gold_frames(tables | {"invoices": layout.whole("invoices")}, params, layout=layout))
