"""Bronze by customer, and heavy keys of the overlap join."""
import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.operators import intervals as I
from ledgerlens.operators import ledger as L
from ledgerlens.operators import rules as R
from ledgerlens.params import DetectorParams
from ledgerlens.plans.flags import flagged_accounts, flagged_by_layout
from ledgerlens.sources.layout import write_layout
from ledgerlens.sources.testdata import billing_tables
from tests.conftest import invoices


def _bag(df):
    return Counter(map(tuple, df.collect()))


def test_layout_with_hot_customers_equals_plain_tables(spark):
    tables = billing_tables(spark, "/root/testdata/sf0.001")
    hot = F.when(F.col("customer_id") % 3 == 0, F.lit(7)).when(F.col("customer_id") % 50 == 1, F.lit(None)).otherwise(F.col("customer_id"))
    tables = {n: t.withColumn("customer_id", hot.cast("long")) for n, t in tables.items() if n != "invoice_allocations"} | {
        "invoice_allocations": tables["invoice_allocations"]}
    params, plain = DetectorParams(hot_group_rows=150), DetectorParams(split_hot=False)
    layout = write_layout(spark, tables, params, buckets=3)
    assert {r[0] for r in layout.hot["ledger_entries"].select("customer_id").distinct().collect()} >= {7}
    assert layout.ordinary["invoices"].filter("customer_id = 7").count() == 0
    assert _bag(layout.whole("invoices")) == _bag(tables["invoices"])
    ent, inv = "ledger_entries", "invoices"
    assert _bag(layout.each(lambda t, p: L.running_balance(t[ent], p), params)) == _bag(L.running_balance(tables[ent], plain))
    assert _bag(layout.each(lambda t, p: R.statement_sequence(t[inv], p), params)) == _bag(R.statement_sequence(tables[inv], plain))
    assert _bag(flagged_by_layout(layout, params)) == _bag(flagged_accounts(tables, plain))
    names = list(layout.names)
    layout.drop()
    assert not [t for t in spark.catalog.listTables() if t.name in names]


def _brute(rows, p):
    day = dt.date.fromisoformat
    rows = [(i, c, day(s), day(e), float(x)) for i, c, s, e, _, x in rows]
    return sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[0] < b[0] and a[2] <= b[3] and b[2] <= a[3]
                  and abs(a[4] - b[4]) <= max(float(p.tolerance_min), float(p.tolerance_ratio) * a[4]) + 1e-9)


def test_customers_of_any_size_give_the_same_pairs(spark):
    rng = random.Random(8)
    rows = []
    for i in range(700):
        start = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(400))
        rows.append((f"I{i:04d}", f"c{rng.choice([0, 0, 0, 1, 2, i])}", str(start), str(start + dt.timedelta(days=rng.choice([0, 3, 30, 400]))),
                     "2024-01-01", rng.choice([100, 100, 101, 250, 1000])))
    frame = invoices(spark, *rows)
    for params in (DetectorParams(), DetectorParams(pairwise_rows=20, heavy_key_rows=5), DetectorParams(pairwise_rows=1, hot_group_rows=100, heavy_key_rows=3)):
        got = sorted((r.a_invoice_id, r.b_invoice_id) for r in I.overlap_pairs(frame, params).collect())
        assert got == _brute(rows, params) and len(got) > 1000


def test_a_heavy_key_is_dealt_to_even_parts(spark):
    """200,000 statements of one customer at one price level: no (key, part) gets more than about its share."""
    n, params = 200_000, DetectorParams(heavy_key_rows=2_000)
    side = spark.range(n).select(F.lit("c").alias("customer_id"), F.col("id").cast("string").alias("invoice_id"), F.lit(3).alias("at"), F.lit(9).alias("bin"))
    a = side.select([F.col(c).alias(f"a_{c}") for c in side.columns])
    b = side.select([F.col(c).alias(f"b_{c}") for c in side.columns])
    a, b = I.in_parts(a.limit(50), b, ["customer_id", "at", "bin"], params)
    sizes = [r["count"] for r in b.groupBy("b_part").count().collect()]
    assert len(sizes) == 100 and sum(sizes) == n and max(sizes) < 2 * sorted(sizes)[50]
    assert Counter(r.a_part for r in a.collect()) == {k: 50 for k in range(100)}


def test_many_alike_statements_in_one_bin(spark):
    n = 3_000
    frame = spark.range(n).select(
        F.col("id").alias("invoice_id"), F.lit("c").alias("customer_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias(
            "statement_period_start"), F.lit("2024-01-31").cast("date").alias("statement_period_end"), F.lit(100).cast("decimal(18,2)").alias("amount_due"))
    params = DetectorParams(hot_group_rows=1000, heavy_key_rows=200)
    pairs = I.overlap_pairs(frame, params)
    got = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a_invoice_id", "b_invoice_id").alias("d")).first()
    assert got.n == got.d == n * (n - 1) // 2


def test_overlap_join_moves_few_rows_of_each_statement(spark, monkeypatch):
    """Periods of 1 to 51 days, prices spread: both sides together are a few rows a statement (over 20 before)."""
    n, moved, whole = 6_000, [], I.in_parts

    def counted(a, b, *more):
        moved.append(a.count() + b.count())
        return whole(a, b, *more)

    monkeypatch.setattr(I, "in_parts", counted)
    start = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(2500)).cast("int"))
    frame = spark.range(n).select(
        F.col("id").cast("string").alias("invoice_id"), (F.col("id") % 3).alias("customer_id"), start.alias("statement_period_start"),
        F.date_add(start, F.pmod(F.hash("id"), F.lit(51))).alias("statement_period_end"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000_000)) / 100 + 900).cast("decimal(18,2)").alias("amount_due"))
    pairs = I.overlap_pairs(frame, DetectorParams())
    assert sum(moved) < 5 * n
    rows = [(r[0], r[1], str(r[2]), str(r[3]), None, r[4]) for r in frame.collect()]
    key = {r[0]: r for r in rows}
    got = pairs.collect()
    assert all(r.a_invoice_id < r.b_invoice_id and float(key[r.a_invoice_id][5]) == float(r.a_amount) and str(r.b_ps) == key[r.b_invoice_id][2] for r in got)
    assert sorted((r.a_invoice_id, r.b_invoice_id) for r in got) == _brute(rows, DetectorParams()) and len(got) > 100
