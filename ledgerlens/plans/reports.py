"""Reports over flagged_accounts: by rule, by month, by severity, and the drill-down list.

All stay distributed DataFrames; no row is collected to the driver.  ``flag_summary`` counts for all
counting reports in one pass over the flags (grouping sets); each of them is a selection of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import rule_dimension
from ledgerlens.functions.severity import severity_rank_col
from ledgerlens.operators.ranking import with_position


BY_RULE, BY_MONTH, BY_SEVERITY = "rule", "month", "severity"


def flag_summary(flags: DataFrame) -> DataFrame:
    """``report, rule_id, severity, month, flags``: the counts of all reports from one pass.

    ``report`` says which grouping a row is of; the columns that it does not group by are null.
    """
    rows = flags.select("rule_id", "severity", F.substring("flag_date", 1, 7).alias("month"))
    keys = [F.col(c) for c in rows.columns]
    rule, severity, month = keys
    counted = rows.groupingSets([[rule], [month], [rule, severity]], *keys).agg(
        F.grouping_id(*keys).alias("_set"), F.count(F.lit(1)).alias("flags"))
    # a bit for each key that is not grouped by, the first key highest
    report = F.when(F.col("_set") == 0b011, BY_RULE).when(F.col("_set") == 0b110, BY_MONTH).otherwise(BY_SEVERITY)
    return counted.select(report.alias("report"), "rule_id", "severity", "month", "flags")


def flags_by_rule(flags: DataFrame) -> DataFrame:
    """Count per rule, zero-filled over all five rules: ``rule_id, rule_label, flags``."""
    return rule_report(flags.groupBy("rule_id").agg(F.count(F.lit(1)).alias("flags")))


def rule_report(counts: DataFrame) -> DataFrame:
    """:func:`flags_by_rule` from ``rule_id, flags``."""
    dim = rule_dimension(counts.sparkSession).select("rule_id", "rule_label")
    # The dimension has exactly five rows: broadcasting it is size-bounded by construction.
    return (
        counts.join(F.broadcast(dim), "rule_id", "right")
        .select("rule_id", "rule_label", F.coalesce(F.col("flags"), F.lit(0)).cast("long").alias("flags"))
        .orderBy("rule_id")
    )


def flags_by_month(flags: DataFrame) -> DataFrame:
    """Count per calendar month of flag_date: ``month (yyyy-MM), flags``."""
    return (
        flags.groupBy(F.substring("flag_date", 1, 7).alias("month"))
        .agg(F.count(F.lit(1)).alias("flags"))
        .orderBy("month")
    )


def flag_drilldown(flags: DataFrame) -> DataFrame:
    """Every flag with its rule label, most urgent first; blank invoice for rule 2."""
    return _listed(flags).orderBy(*_urgency()).drop("flag_id")


def ranked_drilldown(flags: DataFrame) -> DataFrame:
    """:func:`flag_drilldown` with the place of each flag in that order as a column, ``position``.

    Flags alike in the order go by their explanation, so equal positions never depend on chance.
    """
    return with_position(_listed(flags), [*_urgency(), "explanation"]).drop("flag_id")


def ranked_months(months: DataFrame) -> DataFrame:
    """``month, flags`` with the month's place in time as ``position``."""
    return with_position(months, ["month"])


def _urgency() -> list:
    return [severity_rank_col("severity"), "customer_id", "rule_id", "flag_id"]


def _listed(flags: DataFrame) -> DataFrame:
    dim = rule_dimension(flags.sparkSession).select("rule_id", "rule_label")
    return flags.join(F.broadcast(dim), "rule_id").select(
        "flag_id", "customer_id", "rule_id", "rule_label", "severity", "amount",
        F.coalesce(F.col("invoice_id"), F.lit("")).alias("invoice_id"),
        "flag_date", "explanation",
    )


def severity_matrix(flags: DataFrame) -> DataFrame:
    """Flags per (rule_id, severity)."""
    return flags.groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("flags"))
