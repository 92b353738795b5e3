"""Plain textbook forms of the headline operators, timed beside ours on the same tables.

usage: python tools/baseline.py [sf_dir]

The plain forms compute the same rows the direct way: a range join for the as-of balance, one
window per customer, an equi self-join for overlapping statements.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlens.operators import intervals as I  # noqa: E402
from ledgerlens.operators import ledger as L  # noqa: E402
from ledgerlens.operators import rules as R  # noqa: E402
from ledgerlens.operators.allocations import with_sent_date  # noqa: E402
from ledgerlens.params import TESTDATA_PARAMS as P  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.testdata import billing_tables  # noqa: E402


def range_join_asof(targets: DataFrame, entries: DataFrame) -> DataFrame:
    e = L.entry_amounts(entries).select(F.col("customer_id").alias("c"), F.col("date").alias("d"), "amount")
    t = targets.distinct()
    return t.join(e, (t.customer_id == e.c) & (e.d <= t.date), "left").groupBy("customer_id", "date").agg(F.sum("amount").alias("running_balance"))


def window_balance(entries: DataFrame) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("effective_date", "entry_id")
    return L.valid_entries(entries).select("customer_id", "effective_date", "entry_id", F.sum("amount").over(w).alias("running_balance"))


def window_sequence(invoices: DataFrame) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("statement_period_start", "invoice_id")
    return invoices.select("invoice_id", F.lag("statement_period_end").over(w).alias("prev_end"))


def self_join_duplicates(invoices: DataFrame) -> DataFrame:
    a, b = I.statement_periods(invoices).alias("a"), I.statement_periods(invoices).alias("b")
    return a.join(b, F.expr("a.customer_id = b.customer_id and a.invoice_id < b.invoice_id and a.ps <= b.pe and b.ps <= a.pe "
                            "and abs(a.amount_due - b.amount_due) <= greatest(1.00, 0.01 * a.amount_due)"))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", extra={"spark.driver.memory": "16g"})
    t = billing_tables(spark, sf_dir)
    inv, ent = t["invoices"], t["ledger_entries"]
    sent = with_sent_date(inv, P).select("customer_id", F.col("sent_date").alias("date"))
    forms = {
        "running balance": (lambda: window_balance(ent), lambda: L.running_balance(ent, P)),
        "balance as of": (lambda: range_join_asof(sent, ent), lambda: L.balance_asof(sent, L.entry_amounts(ent))),
        "statement sequence": (lambda: window_sequence(inv), lambda: R.statement_sequence(inv, P)),
        "near-identical overlaps": (lambda: self_join_duplicates(inv), lambda: I.overlap_pairs(inv, P)),
    }
    print("operator | plain s | ours s | ratio")
    for name, pair in forms.items():
        best = []
        for make in pair:
            took = []
            for _ in range(4):
                t0 = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - t0)
            best.append(min(took))
        print(f"{name} | {best[0]:.1f} | {best[1]:.1f} | {best[1] / best[0]:.2f}")


if __name__ == "__main__":
    main()
