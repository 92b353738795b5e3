"""

Every query maps the test tables of ``sf_dir`` onto the billing model
(``ledgerlens.sources.testdata``) and runs one operator of the detector over the
whole tables.  Outputs present money as DOUBLE and dates as ISO text so they compare
with the DuckDB oracle in ``oracle_sql.py``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.operators import allocations as A  # noqa: E402
from ledgerlens.operators import intervals as I  # noqa: E402
from ledgerlens.operators import ledger as L  # noqa: E402
from ledgerlens.operators import notices as N  # noqa: E402
from ledgerlens.operators import rules as R  # noqa: E402
from ledgerlens.params import SUPPLIES_PARAMS, TESTDATA_PARAMS, WHATIF_PARAMS, DetectorParams  # noqa: E402
from ledgerlens.plans import digests as D  # noqa: E402
from ledgerlens.plans import flags as G  # noqa: E402
from ledgerlens.plans import medallion as M  # noqa: E402
from ledgerlens.plans import reports as Rp  # noqa: E402
from ledgerlens.plans import validation as V  # noqa: E402
from ledgerlens.session import COMPRESSION, shared_dir  # noqa: E402
from ledgerlens.sources.bronze import read_bronze_csv  # noqa: E402
from ledgerlens.sources.layout import CustomerLayout, write_layout  # noqa: E402
from ledgerlens.sources.testdata import SUPPLIES, billing_tables, expected_defects  # noqa: E402

try:  # the corpus operators are an optional part of the library
    import corpus_pipeline
    from ledgerlens.llm import queries as corpus
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "ledgerlens.llm"):
        raise
    corpus = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
P = TESTDATA_PARAMS


def _out(df: DataFrame) -> DataFrame:
    """Money as DOUBLE, dates as ISO text (the comparison format)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(cols)


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return billing_tables(spark, sf_dir)


def _notices(t: dict[str, DataFrame], params=P) -> DataFrame:
    return N.naive_notices(t["invoices"], t["invoice_allocations"], t["ledger_entries"], params)


def _flags(t: dict[str, DataFrame]) -> DataFrame:
    return G.flagged_accounts(t, P)


def _labels(t: dict[str, DataFrame]) -> DataFrame:
    return expected_defects(_flags(t), t["invoices"])


def _gold_pair(t: dict[str, DataFrame], text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Flags and labels over one Gold run, written column-pruned to the shared folder and read by both."""
    flags = _flags(t) if text else _flags(t).drop("explanation", "flag_date")
    spark = flags.sparkSession
    path = shared_dir(spark, "gold")
    flags.write.option("compression", COMPRESSION).parquet(path)
    flags = spark.read.schema(flags.schema).parquet(path)
    return flags, expected_defects(flags, t["invoices"])


def _q(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _out(fn(_t(spark, sf_dir)))


def _supplies(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """An operator over the second mapping of the test tables."""
    return lambda spark, sf_dir: _out(fn(billing_tables(spark, sf_dir, SUPPLIES)))


_RUNS: dict[tuple[str, str], tuple[str, M.Metrics]] = {}


def _stages(spark: SparkSession, sf_dir: str) -> tuple[str, M.Metrics]:
    """(root, observed metrics) of all stages over the mapped tables, run once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = shared_dir(spark, "medallion")
        _RUNS[key] = root, M.run_stages(spark, _t(spark, sf_dir), root, P)
    return _RUNS[key]


def _medallion(table: str, columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """One of the tables that the stages wrote, as read back."""
    return lambda spark, sf_dir: _out(M.read_table(spark, f"{_stages(spark, sf_dir)[0]}/{table}").select(*columns.split()))


_LAYOUTS: dict[tuple[str, str], CustomerLayout] = {}


def _by_customer(fn: Callable[[dict[str, DataFrame], DetectorParams], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """An operator over the mapped tables laid out by customer, written once per application and folder."""
    return lambda spark, sf_dir: _out(_layout(spark, sf_dir).each(fn, P))


def _layout(spark: SparkSession, sf_dir: str) -> CustomerLayout:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        _LAYOUTS[key] = write_layout(spark, _t(spark, sf_dir), P)
    return _LAYOUTS[key]


def _notice_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The notices under either grace period, written as tables that a digest can be taken of."""
    t, out = _t(spark, sf_dir), []
    for params in (P, WHATIF_PARAMS):
        rows = _notices(t, params).select(F.col("invoice_id").cast("string"), F.col("customer_id").cast("string"), "in_credit")
        path = shared_dir(spark, "notices")
        rows.write.parquet(path)
        out.append(spark.read.schema(rows.schema).parquet(path))
    return out


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapped invoices written as CSV with the columns turned round, and read as Bronze."""
    path = shared_dir(spark, "csv")
    invoices = _t(spark, sf_dir)["invoices"]
    invoices.select(*reversed(invoices.columns)).write.option("header", True).csv(path)
    good, _ = read_bronze_csv(spark, path, "invoices")
    return _out(good.withColumns({c: F.col(c).cast("long") for c in ("invoice_id", "customer_id")}))


def _csv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapped invoices as CSV files of two headers, one with a column of quoted line ends and quotes; read as one Bronze table."""
    path = shared_dir(spark, "csv")
    invoices = _t(spark, sf_dir)["invoices"]
    odd = F.col("invoice_id") % 2 == 1
    note = F.concat(F.lit('two\nlines, "'), F.col("invoice_id").cast("string"), F.lit('"'))
    quoted = {"header": True, "quote": '"', "escape": '"'}
    invoices.filter(odd).write.options(**quoted).csv(f"{path}/odd")
    invoices.filter(~odd).withColumn("note", note).select("note", *reversed(invoices.columns)).write.options(**quoted).csv(f"{path}/even")
    good, _ = read_bronze_csv(spark, [f"{path}/odd", f"{path}/even"], "invoices")
    return _out(good.withColumns({c: F.col(c).cast("long") for c in ("invoice_id", "customer_id")}))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the Gold flagged_accounts table over the sf0.001 tables."""
    return _out(_flags(_t(spark, SMOKE_DIR)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    inv = lambda t: t["invoices"]
    ent = lambda t: t["ledger_entries"]
    alc = lambda t: t["invoice_allocations"]
    q = {
        # sources (mapping of the test tables)
        "billing_customers": _q(lambda t: t["customers"]),
        "billing_invoices": _q(inv),
        "billing_ledger": _q(ent),
        "billing_allocations": _q(alc),
        "supplies_customers": _supplies(lambda t: t["customers"]),
        "supplies_invoices": _supplies(inv),
        "supplies_ledger": _supplies(ent),
        "supplies_allocations": _supplies(alc),
        "supplies_flagged_accounts": _supplies(lambda t: G.flagged_over_lookups(t, SUPPLIES_PARAMS)),
        # filters and predicates
        "valid_ledger": _q(lambda t: L.valid_entries(ent(t))),
        "dishonoured_entries": _q(lambda t: L.dishonoured_entries(ent(t))),
        "credit_candidates": _q(lambda t: A.credit_candidates(ent(t))),
        "under_allocated_invoices": _q(lambda t: N.under_allocated(inv(t), alc(t), P)),
        # silver
        "allocated_at_sent": _q(lambda t: A.allocated_at_sent(inv(t), alc(t), P)),
        "naive_notices": _q(_notices),
        "balance_asof": _q(lambda t: L.balance_asof(
            A.with_sent_date(inv(t), P).select("customer_id", F.col("sent_date").alias("date")), L.entry_amounts(ent(t)))),
        "running_balance": _q(lambda t: L.running_balance(ent(t), P)),
        "end_of_day_balance": _q(lambda t: L.end_of_day_balance(ent(t))),
        "account_balance": _q(lambda t: L.account_balance(ent(t))),
        "overpaid_accounts": _q(lambda t: L.overpaid_accounts(ent(t))),
        "allocated_per_entry": _q(lambda t: A.allocated_per_entry(alc(t))),
        "allocated_per_invoice": _q(lambda t: A.allocated_per_invoice(alc(t))),
        "asof_date": _q(lambda t: inv(t).agg(F.max("due_date").alias("asof_date"))),
        "entry_residuals": _q(lambda t: A.entry_residuals(ent(t), alc(t))),
        "overlapping_statements": _q(lambda t: I.overlap_counts(inv(t))),
        "notice_classes": _q(lambda t: N.notice_classes(_notices(t))),
        "reconciliation_mismatch": _q(lambda t: N.reconciliation_mismatch(_notices(t))),
        "invoice_position": _q(lambda t: N.invoice_position(inv(t), alc(t), ent(t), P)),
        "coverage_gaps": _q(lambda t: R.coverage_gaps(inv(t), P)),
        "continuity_classes": _q(lambda t: R.continuity_classes(inv(t), P)),
        # gold rules
        "rule1_wrongful_notice": _q(lambda t: R.rule1_wrongful_notice(_notices(t), P)),
        "rule2_orphaned_credit": _q(lambda t: R.rule2_orphaned_credit(ent(t), alc(t), inv(t), P)),
        "rule3_statement_gap": _q(lambda t: R.rule3_statement_gap(inv(t), P)),
        "rule4_dishonour": _q(lambda t: R.rule4_dishonour(ent(t), P)),
        "rule4_dishonour_strict": _q(lambda t: R.rule4_dishonour(ent(t), P.with_(dishonour_strict=True))),
        "rule5_duplicate_invoice": _q(lambda t: R.rule5_duplicate_invoice(inv(t), P)),
        "flagged_accounts": _q(_flags),
        "severity_matrix": _q(lambda t: Rp.severity_matrix(_flags(t))),
        # reports
        "flags_by_rule": _q(lambda t: Rp.flags_by_rule(_flags(t))),
        "flags_by_month": _q(lambda t: Rp.flags_by_month(_flags(t))),
        "flag_drilldown": _q(lambda t: Rp.flag_drilldown(_flags(t))),
        # validation
        "detection_scorecard": _q(lambda t: V.detection_scorecard(*_gold_pair(t))),
        "missed_defects": _q(lambda t: V.missed_defects(*_gold_pair(t))),
        "false_positives": _q(lambda t: V.false_positives(*_gold_pair(t, text=True))),
        "severity_confusion": _q(lambda t: V.severity_confusion(*_gold_pair(t))),
        "manifest_shape": _q(lambda t: V.manifest_shape(_labels(t))),
        "notice_set_diff": _q(lambda t: V.notice_set_diff(_notices(t), _labels(t))),
        "customers_by_rule_set": _q(lambda t: V.customers_by_rule_set(_flags(t))),
        "flag_contract_checks": _q(lambda t: V.flag_contract_checks(_flags(t))),
        "bronze_quality_checks": _q(V.bronze_quality_checks),
        "table_diff": _q(lambda t: V.set_diff(
            _notices(t).select(F.col("invoice_id").cast("string"), F.col("customer_id").cast("string"), "in_credit"),
            _notices(t, WHATIF_PARAMS).select(
                F.col("invoice_id").cast("string"), F.col("customer_id").cast("string"), "in_credit"),
        )),
        "table_diff_by_digest": lambda spark, sf_dir: D.digest_diff(*_notice_tables(spark, sf_dir), key=["invoice_id"]),
        # Bronze laid out by customer
        "bucketed_running_balance": _by_customer(lambda t, p: L.running_balance(ent(t), p)),
        "bucketed_end_of_day": _by_customer(lambda t, p: L.end_of_day_balance(ent(t), by_customer=True)),
        "bucketed_continuity": _by_customer(lambda t, p: R.continuity_classes(inv(t), p)),
        "bucketed_rule3": _by_customer(lambda t, p: R.rule3_statement_gap(inv(t), p)),
        "bucketed_rule5": _by_customer(lambda t, p: R.rule5_duplicate_invoice(inv(t), p)),
        "bucketed_flagged_accounts": lambda spark, sf_dir: _out(G.flagged_by_layout(_layout(spark, sf_dir), P)),
        # sources and sinks end to end
        "medallion_roundtrip": _medallion("gold/flagged_accounts", "flag_id rule_id customer_id invoice_id amount severity flag_date explanation"),
        "silver_notices": _medallion("silver/silver_notices", "customer_id invoice_id amount_due sent_date allocated_total_at_sent "
                                     "balance_at_sent in_credit"),
        "silver_running_balance": _medallion("silver/silver_running_balance", "customer_id effective_date entry_id running_balance"),
        "silver_invoices": _medallion("silver/silver_invoices", "invoice_id customer_id amount_due sent_date allocated_total_at_sent"),
        "silver_end_of_day": _medallion("silver/silver_end_of_day", "customer_id effective_date day_amount balance"),
        "report_flags_by_rule": _medallion("reports/flags_by_rule", "rule_id rule_label flags"),
        "report_flags_by_month": _medallion("reports/flags_by_month", "month flags position"),
        "report_severity_matrix": _medallion("reports/severity_matrix", "rule_id severity flags"),
        "flag_summary": _q(lambda t: Rp.flag_summary(_flags(t))),
        "report_flag_drilldown": _medallion("reports/flag_drilldown", "position customer_id rule_id rule_label severity amount invoice_id flag_date explanation"),
        "stage_metrics": lambda spark, sf_dir: M.stage_metrics(spark, _stages(spark, sf_dir)[1]),
        "bronze_csv_roundtrip": _csv_roundtrip,
        "bronze_csv_two_headers": _csv_two_headers,
    }
    if corpus is not None:
        q |= corpus.queries()
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    from oracle_sql import queries_sql

    sql = queries_sql()
    if corpus is not None:
        sql |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {k: sql[k] for k in queries() if k in sql}
