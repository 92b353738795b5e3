"""Notice operators: the naive dunning notices and the views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.allocations import allocated_at_sent, allocated_per_invoice
from ledgerlens.operators.ledger import attach_balance, entry_amounts
from ledgerlens.params import DetectorParams

def under_allocated(invoices: DataFrame, allocations: DataFrame, params: DetectorParams) -> DataFrame:
    """Invoices whose allocated total at the sent date is strictly below the amount due."""
    return allocated_at_sent(invoices, allocations, params).filter(
        F.col("allocated_total_at_sent") < F.col("amount_due")
    )


def naive_notices(invoices: DataFrame, allocations: DataFrame, entries: DataFrame,
                  params: DetectorParams, lookup: DataFrame | None = None) -> DataFrame:
    """Arrears notices a naive rule sends, with the ledger balance at the sent date."""
    return notices_of(allocated_at_sent(invoices, allocations, params), entry_amounts(entries), lookup)


def notices_of(at_sent: DataFrame, amounts: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """The notices of invoices with their total at the sent date (the Silver invoice table).

    A customer without any ledger history counts as balance 0, i.e. in credit.
    ``lookup`` may be a shared balance lookup that covers the notice dates.
    """
    under = at_sent.filter(F.col("allocated_total_at_sent") < F.col("amount_due"))
    withbal = attach_balance(under, amounts, "sent_date", "_bal", lookup)
    bal = F.coalesce(F.col("_bal"), F.lit(0))
    return withbal.select(
        "customer_id", "invoice_id", "amount_due", "sent_date", "allocated_total_at_sent",
        bal.alias("balance_at_sent"),
        (bal >= 0).alias("in_credit"),
    )


def notice_classes(notices: DataFrame) -> DataFrame:
    """Wrongful (sent while in credit) versus legitimate (account really in arrears)."""
    return notices.withColumn(
        "notice_class", F.when(F.col("in_credit"), F.lit("wrongful")).otherwise(F.lit("legitimate"))
    )


def reconciliation_mismatch(notices: DataFrame) -> DataFrame:
    """Allocation says unpaid while the ledger says in credit, with both figures kept."""
    return notices.filter(F.col("in_credit")).select(
        "customer_id", "invoice_id", "sent_date",
        (F.col("amount_due") - F.col("allocated_total_at_sent")).alias("allocation_shortfall"),
        F.col("balance_at_sent").alias("ledger_balance"),
    )


def invoice_position(invoices: DataFrame, allocations: DataFrame, entries: DataFrame,
                     params: DetectorParams) -> DataFrame:
    """One row per invoice: allocated totals, balance at the due date, notice flag."""
    at_sent = allocated_at_sent(invoices, allocations, params)
    total = allocated_per_invoice(allocations)
    pos = at_sent.join(total, "invoice_id", "left").withColumn(
        "due_date", F.date_sub(F.col("sent_date"), params.grace_days)
    )
    pos = attach_balance(pos, entry_amounts(entries), "due_date", "_bal")
    return pos.select(
        "invoice_id", "customer_id", "amount_due", "due_date", "sent_date",
        F.coalesce(F.col("allocated_total"), F.lit(0)).alias("allocated_total"),
        "allocated_total_at_sent",
        F.coalesce(F.col("_bal"), F.lit(0)).alias("balance_at_due"),
        (F.col("allocated_total_at_sent") < F.col("amount_due")).alias("notice_sent"),
    )
