"""Medallion stages: Bronze -> Silver -> Gold -> reports, each an idempotent overwrite.

Each stage reads what the previous stage wrote (after a pre-flight check with a
one-line message), so every stage boundary also cuts the lineage: a lost executor
recomputes from the last written table, not from the raw inputs.  Paths should live
on shared storage (e.g. under ``spark.checkpoint.dir``), never on a machine-local disk.
Tables are replaced by committing a new version (``sources.versions``), and row, reject and flag
counts are observed while the rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import ledger as L
from ledgerlens.operators import notices as N
from ledgerlens.params import RULE_LABELS, DetectorParams
from ledgerlens.plans import flags as G
from ledgerlens.plans import reports as Rp
from ledgerlens.sources.bronze import TABLES, read_bronze_csv, read_table, read_tables
from ledgerlens.sources.versions import write_table

#: What was observed of each table: ``{"bronze/invoices": {"rows": 12}}``.
Metrics = dict[str, dict[str, int]]

SILVER_TABLES = ("silver_running_balance", "silver_end_of_day", "silver_invoices", "silver_notices")


def _p(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def run_bronze(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> Metrics:
    """Persist the four typed input tables under ``root/bronze``; returns the rows of each."""
    return {f"bronze/{name}": write_table(tables[name], _p(root, "bronze", name), fmt) for name in TABLES}


def run_bronze_csv(spark: SparkSession, files: dict[str, str], root: str, fmt: str = "parquet") -> Metrics:
    """Bronze from CSV files ``{table: path}``: typed rows and, beside them, every rejected row.

    Returns the rows of each table and of each table's rejects, as observed while they were written.
    """
    seen = {}
    for name in TABLES:
        for folder, df in zip(("bronze", "bronze_rejects"), read_bronze_csv(spark, files[name], name), strict=True):
            seen[f"{folder}/{name}"] = write_table(df, _p(root, folder, name), fmt)
    return seen


def run_silver(spark: SparkSession, root: str, params: DetectorParams = DetectorParams(),
               fmt: str = "parquet") -> Metrics:
    bronze = read_tables(spark, _p(root, "bronze"), fmt=fmt)
    seen = {f"silver/{name}": write_table(df, _p(root, "silver", name), fmt) for name, df in G.build_silver(bronze, params).items()}
    at_sent, days = (read_table(spark, _p(root, "silver", n), fmt) for n in ("silver_invoices", "silver_end_of_day"))
    notices = N.notices_of(at_sent, L.day_amounts(days))
    return seen | {"silver/silver_notices": write_table(notices, _p(root, "silver", "silver_notices"), fmt, metrics={"in_credit": F.count_if("in_credit")})}


def run_gold(spark: SparkSession, root: str, params: DetectorParams = DetectorParams(),
             fmt: str = "parquet") -> Metrics:
    """The flags; their number by rule is observed as they are written."""
    bronze = read_tables(spark, _p(root, "bronze"), fmt=fmt)
    silver = read_tables(spark, _p(root, "silver"), SILVER_TABLES, fmt)
    flagged = G.flagged_accounts(bronze, params, silver)
    # the rules are parts of a union, so a task writes the files of its rule: no shuffle to gather them
    by_rule = {f"rule_{r}": F.count_if(F.col("rule_id") == r) for r in RULE_LABELS}
    return {"gold/flagged_accounts": write_table(flagged, _p(root, "gold", "flagged_accounts"), fmt, "rule_id", by_rule)}


def read_gold(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, _p(root, "gold", "flagged_accounts"), fmt)


def run_reports(spark: SparkSession, root: str, fmt: str = "parquet") -> Metrics:
    """The counting reports from one pass over the flags, and the drill-down list with positions."""
    flagged = read_gold(spark, root, fmt)
    seen = {"reports/flag_summary": write_table(Rp.flag_summary(flagged), _p(root, "reports", "flag_summary"), fmt)}
    summary = read_table(spark, _p(root, "reports", "flag_summary"), fmt)
    of = lambda report, *columns: summary.filter(F.col("report") == report).select(*columns, "flags")
    reports = {"flags_by_rule": Rp.rule_report(of(Rp.BY_RULE, "rule_id")), "flags_by_month": Rp.ranked_months(of(Rp.BY_MONTH, "month")),
               "severity_matrix": of(Rp.BY_SEVERITY, "rule_id", "severity"), "flag_drilldown": Rp.ranked_drilldown(flagged)}
    return seen | {f"reports/{name}": write_table(df, _p(root, "reports", name), fmt) for name, df in reports.items()}


def run_stages(spark: SparkSession, tables: dict[str, DataFrame], root: str,
               params: DetectorParams = DetectorParams(), fmt: str = "parquet") -> Metrics:
    """Every stage in order; returns what was observed of each table."""
    return (run_bronze(tables, root, fmt) | run_silver(spark, root, params, fmt) | run_gold(spark, root, params, fmt)
            | run_reports(spark, root, fmt))


def run_all(spark: SparkSession, tables: dict[str, DataFrame], root: str,
            params: DetectorParams = DetectorParams(), fmt: str = "parquet") -> DataFrame:
    """Every stage in order; returns the Gold table as read back from storage."""
    run_stages(spark, tables, root, params, fmt)
    return read_gold(spark, root, fmt)


def stage_metrics(spark: SparkSession, seen: Metrics) -> DataFrame:
    """``table_name, metric, value`` of what the stages observed: a few rows per table."""
    rows = [(name, metric, value) for name, metrics in seen.items() for metric, value in metrics.items()]
    return spark.createDataFrame(rows, "table_name string, metric string, value long")
