"""Ledger operators: running balance, end-of-day balance, balance as of a date.

Scale design
------------
A customer may own a large share of all ledger rows, and a window partition is one
task.  Day level: entries are dealt by customer and added up to one row per (customer, day)
as they stream into their task, and only that table is windowed per customer; its size per
customer is bounded by the calendar.  Entry level: the running balance is windowed per
customer, and per slice of the order for hot customers (``operators.skew``).

The as-of lookup ("balance at the end of day d") unions the valid entries with the
(customer, d) targets, deals them by customer, reduces them by one aggregate to a row per
(customer, day), and runs one running sum over those rows: linear, no range join, one shuffle.
A task adds up its customers' entries as they stream in; what it holds and sorts is one row per
customer-day at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.skew import SLICE, renamed, same, separate
from ledgerlens.params import DetectorParams

_UNBOUNDED = Window.unboundedPreceding


def valid_entries(entries: DataFrame) -> DataFrame:
    """Entries that moved money.  A null status is dropped as well (three-valued logic)."""
    return entries.filter(F.col("status") != F.lit("dishonoured"))


def dishonoured_entries(entries: DataFrame) -> DataFrame:
    """Entries whose collection failed."""
    return entries.filter(F.col("status") == F.lit("dishonoured"))


def day_totals(entries: DataFrame) -> DataFrame:
    """Net amount of the valid entries per (customer_id, effective_date)."""
    return valid_entries(entries).groupBy("customer_id", "effective_date").agg(
        F.sum("amount").alias("day_amount")
    )


def end_of_day_balance(entries: DataFrame, by_customer: bool = False) -> DataFrame:
    """``customer_id, effective_date, day_amount, balance``: balance after the day's entries.

    Entries are dealt by customer first, so days are added up and windowed in one shuffle; ``by_customer`` says
    that they already lie so.
    """
    w = Window.partitionBy("customer_id").orderBy("effective_date").rowsBetween(_UNBOUNDED, 0)
    dealt = entries if by_customer else entries.repartition("customer_id")
    return day_totals(dealt).withColumn("balance", F.sum("day_amount").over(w))


def running_balance(entries: DataFrame, params: DetectorParams = DetectorParams()) -> DataFrame:
    """Balance after each valid entry, ordered by (effective_date, entry_id).

    Returns ``customer_id, effective_date, entry_id, running_balance``.  Entries with
    an identical (date, entry_id) share one value (a RANGE frame).

    One plain window serves every ordinary customer.  A hot customer's entries are cut
    into slices of the order (``operators.skew``): a window per slice, plus the total of
    the slices before it.
    """
    valid = valid_entries(entries).select("customer_id", "effective_date", "entry_id", "amount")
    order = ["effective_date", "entry_id"]
    out = ["customer_id", *order, "running_balance"]
    ordinary, hot = separate(valid, ["customer_id"], order, params)
    plain = ordinary.withColumn("running_balance", F.sum("amount").over(Window.partitionBy("customer_id").orderBy(*order)))
    if hot is None:
        return plain.select(*out)
    keys = ["customer_id", SLICE]
    earlier = Window.partitionBy("customer_id").orderBy(SLICE).rowsBetween(_UNBOUNDED, -1)
    carried = renamed(hot.groupBy(*keys).agg(F.sum("amount").alias("_total")).select(
        *keys, F.sum("_total").over(earlier).alias("_carried")), keys)
    inside = hot.withColumn("_inside", F.sum("amount").over(Window.partitionBy(*keys).orderBy(*order)))
    split = inside.join(carried, same(keys, inside, carried)).withColumn(
        "running_balance", F.when(F.col("_inside").isNull(), F.col("_carried"))
        .otherwise(F.col("_inside") + F.coalesce("_carried", F.lit(0))))
    return plain.select(*out).unionByName(split.select(*out))


def entry_amounts(entries: DataFrame) -> DataFrame:
    """``customer_id, date, amount`` of the valid entries: what the as-of lookup adds up."""
    return valid_entries(entries).select("customer_id", F.col("effective_date").alias("date"), "amount")


def entry_movements(entries: DataFrame) -> DataFrame:
    """:func:`entry_amounts` with a row, without amount, for each dishonoured entry, whose day is a target: both from one scan."""
    failed = F.col("status") == F.lit("dishonoured")
    day = F.col("effective_date")
    return entries.filter(F.col("status").isNotNull()).select(
        "customer_id", day.alias("date"), F.when(~failed, F.col("amount")).alias("amount"), (failed & day.isNotNull()).alias("is_target"))


def day_amounts(end_of_day: DataFrame) -> DataFrame:
    """The same from an end-of-day balance table, one row per customer-day."""
    return end_of_day.select("customer_id", F.col("effective_date").alias("date"), F.col("day_amount").alias("amount"))


def balance_asof(targets: DataFrame, amounts: DataFrame, date_col: str = "date",
                 out_col: str = "running_balance") -> DataFrame:
    """End-of-day balance of each distinct (customer_id, date) target.

    ``amounts`` is :func:`entry_amounts`, :func:`day_amounts` or, with targets of its own, :func:`entry_movements`.  Null when the customer has
    no amount on or before the date.  One row per distinct target; amounts without a
    customer belong to no target.

    Plan: amounts and targets are unioned and dealt by customer (ONE shuffle); one aggregate
    reduces them to a row per (customer, day) carrying the day's net amount and whether the
    day is a target, and one running sum per customer over those day rows gives every target
    its balance, both where the rows are.
    """
    moved = amounts.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", F.col("date").alias("_d"), F.col("amount").alias("_amt"),
        (F.col("is_target") if "is_target" in amounts.columns else F.lit(False)).alias("_t"))
    kind = moved.schema["_amt"].dataType
    wanted = targets.select(
        "customer_id", F.col(date_col).alias("_d"), F.lit(None).cast(kind).alias("_amt"), F.lit(True).alias("_t"),
    ).filter(F.col("_d").isNotNull())
    days = moved.unionByName(wanted).repartition("customer_id").groupBy("customer_id", "_d").agg(
        F.sum("_amt").alias("_day"), F.max("_t").alias("_is_target"))
    w = Window.partitionBy("customer_id").orderBy("_d").rowsBetween(_UNBOUNDED, 0)
    return (
        days.withColumn(out_col, F.sum("_day").over(w))
        .filter(F.col("_is_target"))
        .select("customer_id", F.col("_d").alias(date_col), out_col)
    )


def balance_lookup(amounts: DataFrame, target_sets: list[tuple[DataFrame, str]]) -> DataFrame:
    """One as-of lookup serving several target sets: ``customer_id, date, balance``.

    Each consumer joins back to the same lookup, so the ledger is aggregated once for
    all of them (e.g. the notice dates of rule 1 and the dishonour dates of rule 4).
    """
    targets = reduce(
        lambda a, b: a.unionByName(b),
        [df.select("customer_id", F.col(col).alias("date")) for df, col in target_sets],
    )
    return balance_asof(targets, amounts, "date", "balance")


def attach_balance(df: DataFrame, amounts: DataFrame, date_col: str, out_col: str = "balance",
                   lookup: DataFrame | None = None) -> DataFrame:
    """Left-join each row of ``df`` to its customer's end-of-day balance at ``date_col``.

    The lookup runs on the distinct (customer, date) pairs (or is a shared
    :func:`balance_lookup` covering them); the join back is an equi-join that AQE
    turns into a broadcast when the lookup is small, or splits when a key is skewed.
    """
    if lookup is None:
        lookup = balance_lookup(amounts, [(df, date_col)])
    bal = lookup.select(F.col("customer_id").alias("_bc"), F.col("date").alias("_bd"),
                        F.col("balance").alias(out_col))
    joined = df.join(
        bal, (F.col("customer_id") == F.col("_bc")) & (F.col(date_col) == F.col("_bd")), "left"
    )
    return joined.drop("_bc", "_bd")


def account_balance(entries: DataFrame) -> DataFrame:
    """Current account position per customer: ``customer_id, balance, last_entry_date``."""
    return valid_entries(entries).groupBy("customer_id").agg(
        F.sum("amount").alias("balance"), F.max("effective_date").alias("last_entry_date")
    )


def overpaid_accounts(entries: DataFrame) -> DataFrame:
    """Accounts whose balance is positive: the computed overpayment view."""
    return account_balance(entries).filter(F.col("balance") > 0)
