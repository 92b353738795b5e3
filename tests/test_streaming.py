"""Incremental Bronze ingest: only new files are loaded, replays do not duplicate."""
from ledgerlens.session import shared_dir
from ledgerlens.streaming import ingest_csv_stream

HEADER = "entry_id,customer_id,type,amount,effective_date,source,status\n"


def test_stream_ingest_is_incremental_and_exactly_once(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "part1.csv").write_text(HEADER + "e1,A,payment,10.00,2024-01-01,x,settled\n"
                                            "e2,A,payment,oops,2024-01-02,x,settled\n")
    root = shared_dir(spark, "test-stream")
    args = dict(source_dir=str(src), table="ledger_entries", bronze_path=f"{root}/bronze",
                rejects_path=f"{root}/rejects", checkpoint=f"{root}/_checkpoint")
    ingest_csv_stream(spark, **args)
    assert spark.read.parquet(f"{root}/bronze").count() == 1
    assert [r.reject_reason for r in spark.read.parquet(f"{root}/rejects").collect()] == ["amount"]

    (src / "part2.csv").write_text(HEADER + "e3,B,credit,5.50,2024-01-03,x,settled\n")
    ingest_csv_stream(spark, **args)
    ingest_csv_stream(spark, **args)  # nothing new: no duplicate rows
    got = sorted((r.entry_id, str(r.amount)) for r in spark.read.parquet(f"{root}/bronze").collect())
    assert got == [("e1", "10.00"), ("e3", "5.50")]
