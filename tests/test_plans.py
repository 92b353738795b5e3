"""Reports, validation, sources and the medallion stages."""
import datetime as dt
import os
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.params import DetectorParams
from ledgerlens.plans import flags as G
from ledgerlens.plans import medallion as M
from ledgerlens.plans import reports as Rp
from ledgerlens.plans import validation as V
from ledgerlens.schemas import FLAGGED_ACCOUNTS, MANIFEST
from ledgerlens.session import shared_dir
from ledgerlens.sources.bronze import MissingColumn, UpstreamMissing, from_rows, read_bronze_csv, read_labels_csv, read_table, require
from tests.conftest import allocations, entries, invoices


FLAG = [f.name for f in FLAGGED_ACCOUNTS.fields]


def some_flags(spark):
    rows = [("R5_700", 5, "N4", "700", "88.10", "medium", "2022-12-30", "dup"), ("R4_p9", 4, "N5", "", "12.00", "critical", "2023-01-02", "dis"),
            ("R2_k7", 2, "N6", None, "4.75", "warning", "2023-01-31", "orphan"), ("R5_701", 5, "N4", "701", "300", "high", "2023-02-01", "dup"),
            ("R2_k6", 2, "N6", None, "6.00", "warning", "2022-12-01", "orphan")]
    return from_rows(spark, [dict(zip(FLAG, r, strict=True)) for r in rows], schema=FLAGGED_ACCOUNTS)


def test_reports(spark):
    f = some_flags(spark)
    assert [(r.rule_id, r.flags) for r in Rp.flags_by_rule(f).collect()] == [(1, 0), (2, 2), (3, 0), (4, 1), (5, 2)]
    assert [(r.month, r.flags) for r in Rp.flags_by_month(f).collect()] == [("2022-12", 2), ("2023-01", 2), ("2023-02", 1)]
    listed = Rp.flag_drilldown(f).collect()
    assert [(r.severity, r.invoice_id, str(r.amount)) for r in listed] == [
        ("critical", "", "12.00"), ("high", "701", "300.00"), ("medium", "700", "88.10"), ("warning", "", "6.00"), ("warning", "", "4.75")]
    assert {r.rule_label for r in listed if r.rule_id == 4} == {"R4 dishonour"}


def _labels(spark, rows):
    cols = [f.name for f in MANIFEST.fields]
    return from_rows(spark, [dict(zip(cols, r)) for r in rows], schema=MANIFEST)


def test_validation_against_labels(spark):
    f = some_flags(spark)
    labels = _labels(spark, [
        ("L1", "duplicate_invoice", "N4", "700", 5, "high", 88), ("L2", "duplicate_invoice", "N4", "702", 5, "high", 1),
        ("L3", "stale_unswept_credit", "N6", "", 2, "warning", 4), ("L4", "stale_unswept_credit", "N7", "", 2, "warning", 4),
        ("L5", "statement_gap", "N4", "700", 4, "medium", 0)])
    score = {r.rule_id: (r.expected, r.recalled, r.flagged, r.true_flags, r.recall, r.precision) for r in V.detection_scorecard(f, labels).collect()}
    assert score == {1: (0, 0, 0, 0, None, None), 2: (2, 1, 2, 2, 0.5, 1.0), 3: (0, 0, 0, 0, None, None),
                     4: (1, 0, 1, 0, 0.0, 0.0), 5: (2, 1, 2, 1, 0.5, 0.5)}
    assert sorted(r.defect_id for r in V.missed_defects(f, labels).collect()) == ["L2", "L4", "L5"]
    assert sorted(r.flag_id for r in V.false_positives(f, labels).collect()) == ["R4_p9", "R5_701"]
    table = {(r.expected_rule, r.expected_severity, r.assigned_severity): r.labels for r in V.severity_confusion(f, labels).collect()}
    assert table == {(5, "high", "medium"): 1, (5, "high", "missing"): 1, (2, "warning", "warning"): 1, (2, "warning", "missing"): 1,
                     (4, "medium", "missing"): 1}
    assert {r.defect_family: (r.labels, r.rule_mismatches) for r in V.manifest_shape(labels).collect()} == {
        "duplicate_invoice": (2, 0), "stale_unswept_credit": (2, 0), "statement_gap": (1, 1)}
    assert {r.rule_set: r.customers for r in V.customers_by_rule_set(f).collect()} == {"2": 1, "4": 1, "5": 1}
    broken = f.withColumn("severity", F.lit("odd")).withColumn("flag_date", F.lit(" "))
    assert {r.check_name: r.violations for r in V.flag_contract_checks(broken).collect()} == {
        "flag_date_present": 5, "invoice_missing_only_for_rule2": 0, "rule_id_known": 0, "severity_known": 5}


def test_set_diff_and_digest(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    got = sorted((r.side, r.x) for r in V.set_diff(a, b).collect())
    assert got == [("left_only", 1), ("left_only", 2), ("right_only", 3)]
    d1 = V.table_digest(a).collect()[0]
    d2 = V.table_digest(a.orderBy(F.desc("x"))).collect()[0]
    assert d1 == d2 and d1.rows == 3


def test_bronze_quality_checks(spark):
    cust = from_rows(spark, [dict(customer_id="A", plan_id="p", signup_date=None, status="active")], "customers")
    ent = entries(spark, ("e1", "A", "payment", -5, "2024-01-01"), ("e1", "Z", "invoice_debit", -5, "2024-01-01"))
    inv = invoices(spark, ("I1", "A", "2024-02-01", "2024-01-01", "2024-02-05", 1))
    al = allocations(spark, ("a1", "e9", "I1", 1, "2024-01-01"))
    got = {r.check_name: r.violations for r in V.bronze_quality_checks(
        dict(customers=cust, ledger_entries=ent, invoices=inv, invoice_allocations=al)).collect()}
    assert got["ledger_pk_unique"] == 1 and got["ledger_customer_fk"] == 1
    assert got["allocation_entry_fk"] == 1 and got["amount_sign_by_type"] == 1
    assert got["period_start_before_end"] == 1 and got["invoice_customer_fk"] == 0


HEADER = "invoice_id,customer_id,statement_period_start,statement_period_end,due_date,amount_due,issued_date"


@pytest.mark.parametrize(("line", "reason"), [
    ("I7,N1,2023-04-01,2023-04-30,2023-05-09,10.00,2023-04-01", None), ("I7,N1,2023-04-31,2023-04-30,2023-05-09,10.00,2023-04-01", "statement_period_start"),
    ("I7,N1,2023-04-01,2023-04-30,2023-05-09,10.005,2023-04-01", "amount_due"), ("I7,N1,2023-04-01,2023-04-30,2023-05-09,10.500,2023-04-01", None),
    ("I7,N1,2023-04-01,2023-04-30,2023-05-09,oops,oops", "amount_due,issued_date"), ("I7,N1,2023-04-01", "too few fields"),
    ("I7,N1,2023-04-01,2023-04-30,2023-05-09,10,2023-04-01,x", "too many fields"), ('"I,7",N1,2023-04-01,2023-04-30,2023-05-09,,2023-04-01', None)])
def test_csv_rows_are_typed_or_rejected(spark, tmp_path, line, reason):
    path = tmp_path / "invoices.csv"
    path.write_text(f"{HEADER}\n{line}\n")
    good, rejects = read_bronze_csv(spark, str(path), "invoices")
    assert [r.reject_reason for r in rejects.collect()] == ([] if reason is None else [reason])
    assert [r.customer_id for r in good.collect()] == (["N1"] if reason is None else [])


def test_csv_goes_by_header(spark, tmp_path):
    path = tmp_path / "ledger.csv"
    path.write_text("status,source,entry_id,customer_id,type,amount,effective_date\ndishonoured,x,k1,N1,payment,5,2023-01-01\n")
    (row,) = read_bronze_csv(spark, str(path), "ledger_entries")[0].collect()
    assert (row.status, row.source, row.entry_id, str(row.amount)) == ("dishonoured", "x", "k1", "5.00")
    path.write_text("entry_id,customer_id,type,amount,effective_date,source\nk1,N1,payment,5,2023-01-01,x\n")
    with pytest.raises(MissingColumn, match="status"):
        read_bronze_csv(spark, str(path), "ledger_entries")


def test_every_csv_file_keeps_its_own_header(spark, tmp_path):
    folder = tmp_path / "in [1]"
    folder.mkdir()
    (folder / "a.csv").write_text("entry_id,customer_id,type,amount,effective_date,source,status\nk1,N1,payment,5,2023-01-01,direct_debit,settled\n")
    (folder / "b{1}.csv").write_text("note,status,source,effective_date,amount,type,customer_id,entry_id\n"
                                     '"two\nlines","dishonoured","a ""q"", b",2023-01-02,7.50,payment,N2,k2\n'
                                     "plain,settled,x,2023-01-03,oops,payment,N3,k3\n")
    (folder / "c.csv").write_text("entry_id,customer_id,type,amount,effective_date,source,status\n")
    good, rejects = read_bronze_csv(spark, str(folder).replace("[1]", "?1?"), "ledger_entries")
    assert sorted((r.entry_id, r.customer_id, str(r.amount), r.source, r.status) for r in good.collect()) == [
        ("k1", "N1", "5.00", "direct_debit", "settled"), ("k2", "N2", "7.50", 'a "q", b', "dishonoured")]
    assert [(r.entry_id, r.amount, r.note, r.reject_reason) for r in rejects.collect()] == [("k3", "oops", "plain", "amount")]
    assert good.select("customer_id").count() == 2  # no fewer columns make a record look wrong
    (folder / "d.csv").write_text("entry_id,customer_id\nk9,N1\n")
    (folder / "e.csv").write_text("")
    with pytest.raises(MissingColumn, match=r"d\.csv: no column type, amount.*e\.csv: no header"):
        read_bronze_csv(spark, str(folder).replace("[1]", "?1?"), "ledger_entries")


def test_large_files_without_quoted_line_ends_are_split(spark, tmp_path):
    for name, order in (("a", 1), ("b", -1)):
        cols = ["customer_id", "plan_id", "signup_date", "status"][::order]
        rows = [["N%05d" % i, "p", "", "active"][::order] for i in range(20_000)]
        (tmp_path / f"{name}.csv").write_text("\n".join(",".join(r) for r in [cols, *rows]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        good, rejects = read_bronze_csv(spark, str(tmp_path), "customers", quoted_newlines=False)
        assert good.rdd.getNumPartitions() > 4
        assert (good.count(), rejects.count()) == (40_000, 0)
        assert good.groupBy("customer_id", "status").count().filter("count = 2 and status = 'active'").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_labels_file(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("expected_rule,defect_id,defect_family,customer_id,affected_invoice_id,expected_severity,injected_amount\n"
                    "2,D1,x,N1,,warning,4.5\nsecond,D2,x,N1,,warning,4.555\n")
    labels, rejects = read_labels_csv(spark, str(path))
    (row,) = labels.collect()
    assert (row.defect_id, row.expected_rule, row.affected_invoice_id, str(row.injected_amount)) == ("D1", 2, "", "4.50")
    assert [(r.defect_id, r.reject_reason) for r in rejects.collect()] == [("D2", "expected_rule,injected_amount")]


def test_rows_of_a_pandas_frame(spark):
    frame = pd.DataFrame({"customer_id": ["N1", None], "amount": [1.5, None], "entry_id": ["k1", "k2"], "effective_date": ["2023-01-02", None], "more": [1, 2]})
    rows = [(r.entry_id, r.customer_id, r.amount, r.effective_date) for r in from_rows(spark, frame, "ledger_entries").orderBy("entry_id").collect()]
    assert rows == [("k1", "N1", Decimal("1.50"), dt.date(2023, 1, 2)), ("k2", None, None, None)]


def test_bronze_from_csv_keeps_rejects(spark, tmp_path):
    texts = {"customers": "customer_id,plan_id,signup_date,status\nN1,p,,active\n", "invoices": HEADER + "\nI1,N1,2023-01-01\n",
             "ledger_entries": "entry_id,customer_id,type,amount,effective_date,source,status\n",
             "invoice_allocations": "allocation_id,entry_id,invoice_id,amount_allocated,allocated_date\na,b,c,1,2023-01-01\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    root = shared_dir(spark, "test-bronze")
    counts = M.run_bronze_csv(spark, {n: str(tmp_path / f"{n}.csv") for n in texts}, root)
    assert {n: c["rows"] for n, c in counts.items() if n.startswith("bronze_rejects")} == {
        "bronze_rejects/customers": 0, "bronze_rejects/invoices": 1, "bronze_rejects/ledger_entries": 0, "bronze_rejects/invoice_allocations": 0}
    assert counts["bronze/customers"] == {"rows": 1} and counts["bronze/ledger_entries"] == {"rows": 0}
    assert read_table(spark, f"{root}/bronze/customers").count() == 1


def test_absent_tables_are_named_and_broken_ones_are_not_absent(spark, tmp_path):
    for call in (lambda: require(spark, str(tmp_path / "nope")), lambda: read_table(spark, str(tmp_path / "nope"))):
        with pytest.raises(UpstreamMissing, match="nope"):
            call()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet") as e:
        require(spark, str(tmp_path / "broken"))
    assert not isinstance(e.value, UpstreamMissing)


def test_medallion_stages_roundtrip(spark):
    tables = dict(
        customers=from_rows(spark, [dict(customer_id="A", plan_id="p", signup_date=None, status="active")],
                            "customers"),
        ledger_entries=entries(spark, ("d1", "A", "invoice_debit", -100, "2024-01-01"),
                               ("c1", "A", "credit", 150, "2024-01-02")),
        invoices=invoices(spark, ("I1", "A", "2024-01-01", "2024-01-31", "2024-02-05", 100)),
        invoice_allocations=allocations(spark, ("a1", "c1", "I9", 100, "2024-01-03")),
    )
    root = shared_dir(spark, "test-medallion")
    with pytest.raises(UpstreamMissing):
        M.run_gold(spark, root)
    gold = M.run_all(spark, tables, root, DetectorParams())
    direct = G.flagged_accounts(tables, DetectorParams())
    cols = [f.name for f in FLAGGED_ACCOUNTS.fields]
    assert sorted(map(tuple, gold.select(cols).collect())) == sorted(map(tuple, direct.select(cols).collect()))
    assert {r.rule_id for r in gold.collect()} == {1, 2}
    assert os.path.basename(root).startswith("test-medallion")
