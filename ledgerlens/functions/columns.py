"""Small column helpers: money, ISO dates, the five-row rule dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.params import RULE_LABELS, SEVERITY_BASE
from ledgerlens.schemas import MONEY


def money(c: Column | str) -> Column:
    """Exact money: decimal(18,2)."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def money_text(c: Column | str) -> Column:
    """Money as plain text with two decimals, e.g. ``-50.00``; sums may be wider than single amounts."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,2)").cast("string")


def iso_date(c: Column | str) -> Column:
    """A DATE (or ISO text) as ``yyyy-MM-dd`` text."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def rule_dimension(spark: SparkSession) -> DataFrame:
    """The five rules with label and base severity (a fixed five-row dimension)."""
    rows = [(r, RULE_LABELS[r], SEVERITY_BASE[r]) for r in sorted(RULE_LABELS)]
    return spark.createDataFrame(rows, "rule_id int, rule_label string, base_severity string")
