"""Property tests: the bounded-window and binned-join plans against brute force."""
import datetime as dt
import os
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import intervals as I
from ledgerlens.operators import ledger as L
from ledgerlens.operators import rules as R
from ledgerlens.params import DetectorParams
from tests.conftest import entries, invoices

BASE = dt.date(2024, 1, 1)
# LEDGERLENS_EXAMPLES deepens the search (default kept small: every example runs Spark jobs).
SETTINGS = settings(max_examples=int(os.environ.get("LEDGERLENS_EXAMPLES", "8")), deadline=None,
                    suppress_health_check=list(HealthCheck))

entry_rows = st.lists(
    st.tuples(st.sampled_from("AB"), st.integers(-300, 300), st.integers(0, 12), st.booleans()),
    min_size=1, max_size=25,
)
inv_rows = st.lists(
    st.tuples(st.sampled_from("AB"), st.integers(0, 90), st.integers(-3, 58),
              st.sampled_from([100, 101, 150, 100.5, 99, 1000, 1009, 1011, 0, -5, -5.5, 250000])),
    min_size=1, max_size=18,
)


def _d(n):
    return (BASE + dt.timedelta(days=n)).isoformat()


@SETTINGS
@given(entry_rows, st.lists(st.tuples(st.sampled_from("ABC"), st.integers(-2, 14)), min_size=1, max_size=8))
def test_balance_asof_matches_brute_force(spark, rows, targets):
    e = entries(spark, *[(f"e{i:02d}", c, "p", a, _d(d), "dishonoured" if bad else "settled")
                         for i, (c, a, d, bad) in enumerate(rows)])
    t = spark.createDataFrame([(c, BASE + dt.timedelta(days=d)) for c, d in targets],
                              "customer_id string, date date")
    got = {(r.customer_id, r.date): r.running_balance for r in L.balance_asof(t, L.entry_amounts(e)).collect()}
    want = {}
    for c, d in set(targets):
        day = BASE + dt.timedelta(days=d)
        hits = [a for (cc, a, dd, bad) in rows if cc == c and not bad and BASE + dt.timedelta(days=dd) <= day]
        want[(c, day)] = Decimal(sum(hits)).quantize(Decimal("0.01")) if hits else None
    assert got == want


# Tiny thresholds force the hot-group path: every group with more than 2 rows is cut into slices.
HOT = DetectorParams(hot_group_rows=2, max_hot_groups=1_000_000)


@SETTINGS
@given(entry_rows, st.sampled_from([DetectorParams(), HOT, DetectorParams(split_hot=False)]))
def test_running_balance_matches_brute_force(spark, rows, params):
    data = [(f"e{i:02d}", c, "p", a, _d(d % 3), "dishonoured" if bad else "settled")
            for i, (c, a, d, bad) in enumerate(rows)]
    got = {r.entry_id: r.running_balance for r in L.running_balance(entries(spark, *data), params).collect()}
    want = {}
    for c in "AB":
        run = 0
        for eid, cc, _, a, d, st_ in sorted((r for r in data if r[1] == c and r[5] != "dishonoured"),
                                            key=lambda r: (r[4], r[0])):
            run += a
            want[eid] = Decimal(run).quantize(Decimal("0.01"))
    assert got == want


def _inv(spark, rows):
    return invoices(spark, *[(f"I{i:02d}", c, _d(s), _d(s + ln), _d(s + ln + 5), amt)
                             for i, (c, s, ln, amt) in enumerate(rows)])


@SETTINGS
@given(inv_rows, st.sampled_from([DetectorParams(), HOT]))
def test_statement_sequence_matches_brute_force(spark, rows, p):
    rows = [(c, s % 20, ln, amt) for c, s, ln, amt in rows]  # many same-day starts
    inv = _inv(spark, rows)
    got3 = sorted(r.invoice_id for r in R.rule3_statement_gap(inv, p).collect())
    gotc = sorted(r.invoice_id for r in R.coverage_gaps(inv, p).collect())
    want3, wantc = [], []
    for c in "AB":
        seq = sorted(((s, f"I{i:02d}", s + ln) for i, (cc, s, ln, _) in enumerate(rows) if cc == c))
        for k in range(1, len(seq)):
            s, iid, _ = seq[k]
            if s - seq[k - 1][2] > p.gap_threshold_days:
                want3.append(iid)
            if s - max(x[2] for x in seq[:k]) > p.gap_threshold_days:
                wantc.append(iid)
    assert got3 == sorted(want3)
    assert gotc == sorted(wantc)


@SETTINGS
@given(inv_rows, st.sampled_from([1, 40, 50_000]), st.booleans(),
       st.sampled_from([("0.01", "1.00"), ("0.5", "0.10"), ("0", "2.00"), ("0.02", "0"), ("0", "0")]))
def test_binned_overlap_join_matches_all_pairs(spark, rows, stretch, banding, tol):
    ratio, minimum = Decimal(tol[0]), Decimal(tol[1])
    p = DetectorParams(amount_banding=banding, tolerance_ratio=ratio, tolerance_min=minimum)
    rows = [(c, s, ln * stretch if k % 3 == 0 else ln, amt) for k, (c, s, ln, amt) in enumerate(rows)]  # up to 8,000 years
    inv = _inv(spark, rows)
    got_pairs = sorted((r.a_invoice_id, r.b_invoice_id) for r in I.overlap_pairs(inv, p, near_identical=False).collect())
    got_dup = sorted((r.a_invoice_id, r.b_invoice_id)
                     for r in I.overlap_pairs(inv, p, near_identical=True).collect())
    want_pairs, want_dup = [], []
    for i, (ca, sa, la, xa) in enumerate(rows):
        for j, (cb, sb, lb, xb) in enumerate(rows):
            ia, ib = f"I{i:02d}", f"I{j:02d}"
            if ca != cb or not ia < ib:
                continue
            if sa <= sb + lb and sb <= sa + la:
                want_pairs.append((ia, ib))
                a, b = Decimal(str(xa)), Decimal(str(xb))
                if abs(a - b) <= max(minimum, ratio * a):
                    want_dup.append((ia, ib))
    assert got_pairs == sorted(want_pairs)
    valid = {f"I{i:02d}" for i, r in enumerate(rows) if r[2] >= 0}
    counts = {r.invoice_id: r.overlapping for r in I.overlap_counts(inv).collect()}
    assert counts == {i: sum(i in pair and set(pair) <= valid for pair in want_pairs) for i in valid}
    assert got_dup == sorted(want_dup)
