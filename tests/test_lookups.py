"""The Gold table where invoices are looked up in a large table, and overlaps compared where a customer's rows lie."""
import datetime as dt
import random
from collections import Counter

import pytest

import __spark_entry__ as E
from ledgerlens.operators import intervals as I
from ledgerlens.params import SUPPLIES_PARAMS, DetectorParams
from ledgerlens.plans.flags import flagged_accounts, flagged_over_lookups
from ledgerlens.session import FREE_SHUFFLES, written
from ledgerlens.sources.testdata import READ_SCHEMAS, SUPPLIES
from tests.conftest import invoices


def _bag(df):
    return Counter(map(tuple, df.collect()))


def _exchanges(df) -> list[str]:
    """The first key of every shuffle by key of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def star(spark):
    """Line items of a supplier with many, of some with few and of none; part 5 is there twice, part 9 not at all."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        day = None if i % 97 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(700))
        rows.append((i // 3, rng.choice([1, 2, 5, 9, None]), rng.choice([1, 1, 1, 2, 3, 4, None]), i % 3 + 1, rng.choice([100.0, 100.5, 250.0, 60000.0, None]),
                     rng.choice([0.0, 0.05]), *rng.choice([("R", "F"), ("A", "F"), ("N", "O"), ("N", "F")]), day))
    rows += rows[:40]
    return {
        "lineitem": spark.createDataFrame(rows, READ_SCHEMAS["lineitem"]).localCheckpoint(),
        "part": spark.createDataFrame([(1, 10), (2, 50), (5, 3), (5, 30), (None, 7)], READ_SCHEMAS["part"]).localCheckpoint(),
        "supplier": spark.createDataFrame([(k, 1, 1.0) for k in range(1, 5)], READ_SCHEMAS["supplier"]),
        "nation": spark.createDataFrame([(1, "x")], READ_SCHEMAS["nation"]),
    }


@pytest.mark.parametrize("params", [SUPPLIES_PARAMS, SUPPLIES_PARAMS.with_(pairwise_rows=40), SUPPLIES_PARAMS.with_(pairwise_rows=5, heavy_key_rows=3, hot_group_rows=100)])
def test_invoices_looked_up_once_give_the_same_flags(star, params):
    tables = SUPPLIES.tables(star)
    want = _bag(flagged_accounts(tables, params))
    assert {r[1] for r in want} == {1, 2, 3, 4, 5}
    assert _bag(flagged_over_lookups(tables, params)) == want


def test_supplies_shuffle_no_line_items_by_part_when_read(no_broadcast, star, tmp_path):
    for name, df in star.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    flags = E.queries()["supplies_flagged_accounts"](no_broadcast, str(tmp_path))
    keys = _exchanges(flags)
    assert keys and not [k for k in keys if k.endswith("partkey") or k.endswith(("_at", "_bin"))]
    assert keys.count("invoice_id") == 0  # the allocations at the sent date are found once, before


def test_statements_of_middling_customers_are_shuffled_once_by_customer(no_broadcast):
    rows = [(f"I{k:03d}", f"c{k % 3}", f"2023-{1 + k % 12:02d}-01", f"2023-{1 + k % 12:02d}-20", "2024-01-01", 100 + k % 9) for k in range(120)]
    params = DetectorParams(pairwise_rows=20)
    pairs = I.overlap_pairs(invoices(no_broadcast, *rows).localCheckpoint(), params)
    assert _exchanges(pairs) == ["customer_id"]
    direct = I.overlap_pairs(invoices(no_broadcast, *rows), DetectorParams())
    assert _bag(pairs) == _bag(direct) and pairs.count() > 100


@pytest.mark.parametrize("near_identical", [True, False])
def test_pairs_met_where_they_lie_equal_those_of_the_joins(spark, near_identical):
    rng = random.Random(11)
    rows = []
    for i in range(150):
        start = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(300))
        end = start + dt.timedelta(days=rng.choice([-20, 0, 3, 30, 400, 5000]))
        rows.append((f"I{i:03d}", f"c{rng.choice([0, 0, 1])}", str(start), str(end), "2024-01-01", rng.choice([-100, -5, 0, 0.5, 100, 101, 108, 250, 1000])))
    base = I.statement_periods(invoices(spark, *rows, *rows[:30])).localCheckpoint()  # thirty of them twice
    for params in (DetectorParams(), DetectorParams(tolerance_ratio=0, heavy_key_rows=4), DetectorParams(amount_banding=False)):
        got = [_bag(I._named(f(base, params, near_identical))) for f in (I._together, I._binned, I._pairwise)]
        assert got[0] == got[1] == got[2] and sum(got[0].values()) > 300


def test_written_rows_are_read_back_and_the_setting_is_put_back(spark):
    before = spark.conf.get(FREE_SHUFFLES)
    df = spark.range(50).selectExpr("id % 7 as k", "cast(id as decimal(18,2)) as x").groupBy("k").sum("x")
    back = written(df, "sums")
    assert _bag(back) == _bag(df) and back.schema == df.schema
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(FREE_SHUFFLES) == before
