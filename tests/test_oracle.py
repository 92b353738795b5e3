"""Every registered query against its DuckDB oracle on the smallest test tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
assert os.path.isdir(SF), "the test tables are missing"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "supplier", "nation", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# The corpus queries are tested against their SQL in tests of their own.
CORE = sorted(n for n in E.oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["flag_id", "rule_id", "customer_id", "invoice_id", "amount", "severity",
                          "flag_date", "explanation"]
    assert df.count() > 0
