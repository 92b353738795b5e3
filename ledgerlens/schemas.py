"""Typed schemas of the billing model.  Money is decimal(18,2), dates are DATE."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("plan_id", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("status", T.StringType()),
])

LEDGER_ENTRIES = T.StructType([
    T.StructField("entry_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("effective_date", T.DateType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
])

INVOICES = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("statement_period_start", T.DateType()),
    T.StructField("statement_period_end", T.DateType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("amount_due", MONEY),
    T.StructField("issued_date", T.DateType()),
])

INVOICE_ALLOCATIONS = T.StructType([
    T.StructField("allocation_id", T.StringType()),
    T.StructField("entry_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("amount_allocated", MONEY),
    T.StructField("allocated_date", T.DateType()),
])

BRONZE = {
    "customers": CUSTOMERS,
    "ledger_entries": LEDGER_ENTRIES,
    "invoices": INVOICES,
    "invoice_allocations": INVOICE_ALLOCATIONS,
}

NOTICES = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("amount_due", MONEY),
    T.StructField("sent_date", T.DateType()),
    T.StructField("allocated_total_at_sent", MONEY),
    T.StructField("balance_at_sent", MONEY),
    T.StructField("in_credit", T.BooleanType()),
])

# Gold output: one row per anomaly instance.
FLAGGED_ACCOUNTS = T.StructType([
    T.StructField("flag_id", T.StringType()),
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("severity", T.StringType()),
    T.StructField("flag_date", T.StringType()),
    T.StructField("explanation", T.StringType()),
])

# Ground-truth labels: one row per planted defect.
MANIFEST = T.StructType([
    T.StructField("defect_id", T.StringType()),
    T.StructField("defect_family", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("affected_invoice_id", T.StringType()),
    T.StructField("expected_rule", T.IntegerType()),
    T.StructField("expected_severity", T.StringType()),
    T.StructField("injected_amount", MONEY),
])
