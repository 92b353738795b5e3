"""Committed table versions, observed counts, positions and the one-pass summary."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import with_position
from ledgerlens.plans import reports as Rp
from ledgerlens.session import remove, shared_dir
from ledgerlens.sources import versions as V
from ledgerlens.sources.bronze import UpstreamMissing, read_table, require
from tests.test_plans import some_flags


def rows(df):
    return sorted(r.id for r in df.collect())


def test_a_write_that_stops_before_its_commit_leaves_the_old_table(spark):
    path = shared_dir(spark, "table")
    with pytest.raises(UpstreamMissing):
        require(spark, path)
    V.stage(spark.range(9), path)  # the first write stops after its rows, before its commit: no table yet
    with pytest.raises(UpstreamMissing):
        read_table(spark, path)
    assert V.write_table(spark.range(3), path) == {"rows": 3}
    early = read_table(spark, path)
    V.stage(spark.range(100, 105), path)  # stops again: the table is the old one
    assert rows(read_table(spark, path)) == [0, 1, 2]
    assert V.write_table(spark.range(50, 52), path) == {"rows": 2}
    assert rows(read_table(spark, path)) == [50, 51]
    assert rows(early) == [0, 1, 2]  # a reader that began before keeps its version


def test_the_log_tells_what_each_version_held(spark):
    path = shared_dir(spark, "table")
    for n in (4, 0, 7):
        V.write_table(spark.range(n), path, metrics={"odd": F.count_if(F.col("id") % 2 == 1)})
    log = V.commits(spark, path).orderBy("sequence").collect()
    assert [(r.sequence, r.metrics) for r in log] == [(1, {"rows": 4, "odd": 2}), (2, {"rows": 0, "odd": 0}), (3, {"rows": 7, "odd": 3})]
    assert V.vacuum(spark, path) == [log[1].version, log[0].version]
    assert rows(read_table(spark, path)) == list(range(7))
    # a tie of two writers that saw the same log: one of them is the table, for every reader
    for version in ("v-a", "v-b"):
        spark.range(ord(version[-1])).write.parquet(f"{path}/{version}")
        spark.createDataFrame([(4, version, {"rows": 0})], "sequence long, version string, metrics map<string, long>").withColumn(
            "committed", F.current_timestamp()).write.mode("append").parquet(f"{path}/_log")
    assert V.latest(spark, path) == (4, "v-b") and read_table(spark, path).count() == ord("b")


def test_partitioned_versions_and_plain_tables(spark):
    path = shared_dir(spark, "table")
    V.write_table(spark.range(10).withColumn("k", F.col("id") % 2), path, partition_by="k")
    assert {(r.id, r.k) for r in read_table(spark, path).collect()} == {(i, i % 2) for i in range(10)}
    plain = shared_dir(spark, "plain")
    spark.range(2).write.parquet(plain)
    assert rows(read_table(spark, plain)) == [0, 1]
    remove(spark, plain)
    with pytest.raises(UpstreamMissing):
        read_table(spark, plain)


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_positions_equal_a_plain_sort(spark, ranges):
    rng = random.Random(ranges)
    data = [(rng.choice("abc") if rng.random() < 0.9 else None, rng.randrange(4), i) for i in range(500)] + [("b", 2, 1000 + i) for i in range(400)]
    df = spark.createDataFrame(data, "x string, y int, z int").repartition(5)
    found = with_position(df, [F.desc_nulls_last("x"), "y", "z"], "at", ranges)
    order = {r: i + 1 for i, r in enumerate(sorted(data, key=lambda r: (r[0] is None, [-ord(c) for c in r[0] or ""], r[1], r[2])))}
    assert {(r.x, r.y, r.z): r.at for r in found.collect()} == order
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert with_position(df.limit(0), ["x"]).collect() == []


def test_all_counting_reports_come_from_one_scan(spark):
    f = some_flags(spark)
    summary = Rp.flag_summary(f)
    of = lambda report, *columns: sorted(tuple(r) for r in summary.filter(F.col("report") == report).select(*columns, "flags").collect())
    assert of(Rp.BY_RULE, "rule_id") == [(2, 2), (4, 1), (5, 2)]
    assert of(Rp.BY_MONTH, "month") == [("2022-12", 2), ("2023-01", 2), ("2023-02", 1)]
    assert of(Rp.BY_SEVERITY, "rule_id", "severity") == sorted(tuple(r) for r in Rp.severity_matrix(f).collect())
    path = shared_dir(spark, "flags")
    f.write.parquet(path)
    plan = Rp.flag_summary(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    ranked = Rp.ranked_drilldown(f).orderBy("position").collect()
    assert [(r.position, r.explanation) for r in ranked] == [(i + 1, r.explanation) for i, r in enumerate(Rp.flag_drilldown(f).collect())]


def test_tables_between_steps_are_compressed_well(spark):
    from ledgerlens.params import TESTDATA_PARAMS
    from ledgerlens.sources.layout import write_layout
    from ledgerlens.sources.testdata import billing_tables

    path = shared_dir(spark, "table")
    V.write_table(spark.range(9), path)
    layout = write_layout(spark, billing_tables(spark, "/root/testdata/sf0.001"), TESTDATA_PARAMS, buckets=2)
    files = [f for df in (V.load(spark, path), layout.whole("invoices"), layout.whole("ledger_entries")) for f in df.inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files if "_log" not in f)
    layout.drop()


def test_flags_are_written_without_a_shuffle_to_gather_rules(spark, monkeypatch):
    from ledgerlens.plans import medallion as M

    written = []
    monkeypatch.setattr(M, "read_tables", lambda *a, **kw: {})
    monkeypatch.setattr(M.G, "flagged_accounts", lambda *a: some_flags(spark))
    monkeypatch.setattr(M, "write_table", lambda df, *a: written.append(df._jdf.queryExecution().executedPlan().toString()) or {})
    M.run_gold(spark, "nowhere")
    assert written and "Exchange" not in written[0]
