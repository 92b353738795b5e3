"""Hot groups: sliced windows equal plain ones, whatever exchanges Spark reuses."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ledger import running_balance
from ledgerlens.operators.rules import statement_sequence
from ledgerlens.operators.skew import SLICE, separate
from ledgerlens.params import DetectorParams

ROWS = 300_000
SPLIT = DetectorParams(hot_group_rows=1000)
PLAIN = DetectorParams(split_hot=False)


@pytest.fixture
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield spark
    spark.conf.unset("spark.sql.exchange.reuse")


def _spread(spark):
    """One hot customer-day, a hot null customer, a hot null date, some small customers."""
    i = F.col("id")
    return spark.range(ROWS + 40_000).select(
        F.when(i < ROWS, "hot").when(i < ROWS + 10_000, F.lit(None)).when(i < ROWS + 20_000, "dateless")
        .otherwise(F.concat(F.lit("c"), (i % 4000).cast("string"))).alias("customer_id"),
        F.when((i >= ROWS + 10_000) & (i < ROWS + 20_000), F.lit(None))
        .when(i < ROWS, F.lit("2024-02-01")).otherwise(F.concat(F.lit("2024-03-"), F.lpad((i % 28 + 1).cast("string"), 2, "0")))
        .cast("date").alias("day"),
        F.pmod(i * 7919, F.lit(200_003)).cast("string").alias("key"), i.alias("n"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_running_balance_of_hot_customers(no_reuse):
    e = _spread(no_reuse).select(
        F.col("key").alias("entry_id"), "customer_id", F.lit("payment").alias("type"),
        ((F.col("n") % 1000) / 100 - 4).cast("decimal(18,2)").alias("amount"), F.col("day").alias("effective_date"),
        F.lit("x").alias("source"), F.lit("settled").alias("status"))
    assert _same(running_balance(e, SPLIT), running_balance(e, PLAIN))


def test_statement_sequence_of_hot_customers(no_reuse):
    inv = _spread(no_reuse).select(
        F.concat("key", F.lit("-"), F.col("n").cast("string")).alias("invoice_id"), "customer_id",
        F.col("day").alias("statement_period_start"),
        F.when(F.col("n") % 50 != 0, F.date_add("day", F.pmod("n", F.lit(90)).cast("int"))).alias("statement_period_end"))
    assert _same(statement_sequence(inv, SPLIT), statement_sequence(inv, PLAIN))


def test_slices_are_even_and_follow_the_order(spark):
    df = _spread(spark).select("customer_id", "day", "key")
    ordinary, hot = separate(df, ["customer_id"], ["day", "key"], SPLIT)
    assert {r[0] for r in hot.select("customer_id").distinct().collect()} == {"hot", None, "dateless"}
    assert ordinary.count() + hot.count() == df.count()
    sizes = [r["count"] for r in hot.groupBy("customer_id", SLICE).count().collect()]
    assert max(sizes) < 20 * SPLIT.hot_group_rows and len(sizes) > 100
    w = Window.partitionBy("customer_id").orderBy("day", "key")
    backwards = hot.withColumn("before", F.lag(SLICE).over(w)).filter(F.col("before") > F.col(SLICE))
    assert backwards.count() == 0


def test_only_the_largest_groups_are_listed(spark):
    df = spark.range(600).select(F.when(F.col("id") < 400, "a").otherwise("b").alias("k"), "id")
    ordinary, hot = separate(df, ["k"], ["id"], DetectorParams(hot_group_rows=100, max_hot_groups=1))
    assert ordinary.count() == 200 and hot.count() == 400
