"""Overlapping statement periods of one customer, without an all-pairs blow-up.

Two statements overlap when ``a.ps <= b.pe and b.ps <= a.pe`` (closed intervals).

Near-duplicates (``overlap_pairs``).  Where no customer has more than ``pairwise_rows`` statements, which one
count by customer tells beforehand, they meet by customer: candidates per statement are bounded by that number.
Otherwise only those statements meet that can match.  Of two overlapping periods the one that starts later starts
inside the other.  So on one side of the join (``b``) a statement lies at its start alone, on the other (``a``) in all bins
that its period touches, and every pair comes out once, the earlier start on the ``a`` side.  A period of up to
2^k days has level k, a multiple of ``LEVELS``, and touches at most two bins of its level (bins of 2^k days).  Two
periods meet in the bins of the longer one's level, so a statement also gets a row for each longer level that
occurs at all: a few rows at the very most, however long the period.  The key also carries an amount band:
``b`` sits in the band of its amount, ``a`` in the bands of the amounts that may match it, which is mostly one,
since a band is ``BANDS`` tolerances wide.  Bins and bands are monotone, which is all that exactness needs, and
the exact predicates are checked after the join.  Keys of over ``heavy_key_rows`` statements (many alike at one time)
are counted first; their ``b`` side is dealt to parts by a hash and their ``a`` side repeated for each part, so no
task gets a key whole, however large its customer.

Most customers need no shuffle by such keys: those of up to ``TOGETHER * pairwise_rows`` statements.  Theirs are dealt by
customer, each moved once (not at all where they lie so), and get their rows in bins and bands in that task.  Keys of one
statement are dropped there, and those that share a key are compared.  Only larger customers, which the count tells, go
through the join.

Counts (``overlap_counts``): how many statements overlap each one is the number of starts up
to its end less the number of ends before its start, less itself: two running sums over one
row per customer-day, no pairs at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.skew import hot_keys, renamed, same
from ledgerlens.params import DetectorParams

_COLS = ["customer_id", "invoice_id", "ps", "pe", "amount_due"]
#: Levels are multiples of this; a level more is a row more of every shorter period, a wider one more candidates.
LEVELS = 3
#: Customers of up to this many times ``pairwise_rows`` statements are compared in one task each.
TOGETHER = 8
#: Width of an amount band in tolerances: a statement's matches lie in 1 + 2 / BANDS bands on average.
BANDS = 8


def _level(lo: Column, hi: Column) -> Column:
    """The least multiple k of ``LEVELS`` with a period of at most 2^k days."""
    return (F.ceil(F.log2((F.datediff(hi, lo) + 1).cast("double")) / LEVELS) * LEVELS).cast("int")


def _bin(day: Column, level: Column) -> Column:
    return F.floor(F.unix_date(day) / F.pow(F.lit(2.0), level)).cast("long")


def tolerance(amount: Column, params: DetectorParams) -> Column:
    """Near-identical amount tolerance of a statement: ``max(min, ratio * amount)``."""
    return F.greatest(F.lit(params.tolerance_min), F.lit(params.tolerance_ratio) * amount)


def _band(x: Column, params: DetectorParams) -> Column:
    """Monotone amount band: steps of the least tolerance (a cent where it is 0), then geometric where the ratio takes over; ``BANDS`` of either."""
    ratio, unit = float(params.tolerance_ratio), max(float(params.tolerance_min), 0.01)
    xd = x.cast("double")
    steps = F.floor(xd / F.lit(unit * BANDS))
    if not ratio:
        return steps.cast("long")
    knee = max(float(params.tolerance_min) / ratio, unit)
    beyond = F.lit(math.floor(knee / (unit * BANDS))) + F.floor(F.log(xd / F.lit(knee)) / F.lit(math.log1p(ratio) * BANDS))
    return F.when(xd < F.lit(knee), steps).otherwise(beyond).cast("long")


def _bands(amount: Column, params: DetectorParams) -> Column:
    """The bands of all amounts that may match ``amount``, whichever of the two the tolerance is taken of (and a cent more, for rounding)."""
    x, ratio, least = amount.cast("double"), float(params.tolerance_ratio), float(params.tolerance_min)
    down = x - F.greatest(F.lit(least), F.lit(ratio) * x)
    up = F.greatest(x + F.lit(least), x / F.lit(1 - ratio))
    slack = F.lit(0.01) + F.abs(x) * F.lit(1e-9)
    return F.sequence(_band(down - slack, params), _band(up + slack, params))


def statement_periods(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "customer_id", "invoice_id",
        F.col("statement_period_start").alias("ps"),
        F.col("statement_period_end").alias("pe"),
        "amount_due",
    )


def overlap_pairs(invoices: DataFrame, params: DetectorParams, near_identical: bool = True) -> DataFrame:
    """Pairs (a, b) of one customer's statements with ``a.invoice_id < b.invoice_id``
    whose periods overlap; with ``near_identical`` also ``|a - b| <= t(a)``.

    Columns: ``customer_id, a_invoice_id, b_invoice_id, a_ps, a_pe, b_ps, b_pe,
    a_amount, b_amount``.  One row per pair, so n alike statements give n (n - 1) / 2.
    """
    base = statement_periods(invoices).dropna(subset=["customer_id", "invoice_id", "ps", "pe"])
    if near_identical:
        base = base.dropna(subset=["amount_due"])
    sizes = base.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    limit = TOGETHER * params.pairwise_rows
    most, large = sizes.agg(F.max("n"), F.count_if(F.col("n") > limit)).first()  # a job that tells which plan is needed
    if (most or 0) <= params.pairwise_rows:
        return _named(_pairwise(base, params, near_identical))
    if not large:
        return _named(_together(base, params, near_identical))
    if large > params.max_hot_groups:  # too many for a list
        return _named(_binned(base, params, near_identical))
    listed = F.broadcast(renamed(hot_keys(base, ["customer_id"], params.with_(hot_group_rows=limit)), ["customer_id"]))
    of = lambda how: base.join(listed, same(["customer_id"], base, listed), how)
    return _named(_together(of("left_anti"), params, near_identical).unionByName(_binned(of("left_semi"), params, near_identical)))


def _named(met: DataFrame) -> DataFrame:
    return met.select(
        F.col("a_customer_id").alias("customer_id"),
        "a_invoice_id", "b_invoice_id", "a_ps", "a_pe", "b_ps", "b_pe",
        F.col("a_amount_due").alias("a_amount"), F.col("b_amount_due").alias("b_amount"),
    )


def _side(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}_{c}") for c in [*_COLS, *more]])


def _of(prefix: str) -> Callable[[str], Column]:
    """A statement's fields as columns of one side of a join."""
    return lambda c: F.col(f"{prefix}_{c}")


def _overlap(a: Callable[[str], Column], b: Callable[[str], Column], params: DetectorParams, near_identical: bool, first: Column | None = None) -> Column:
    """The exact predicates of two different statements; the tolerance is that of ``a``, or of ``b`` where ``first`` does not hold."""
    cond = (a("invoice_id") != b("invoice_id")) & (a("ps") <= b("pe")) & (b("ps") <= a("pe"))
    if near_identical:
        amount = a("amount_due") if first is None else F.when(first, a("amount_due")).otherwise(b("amount_due"))
        cond = cond & (F.abs(a("amount_due") - b("amount_due")) <= tolerance(amount, params))
    return cond


def _matches(params: DetectorParams, near_identical: bool) -> Column:
    """The exact predicates of a pair, ``a`` the one of the smaller id."""
    return (F.col("a_invoice_id") < F.col("b_invoice_id")) & _overlap(_of("a"), _of("b"), params, near_identical)


def _meet_once(a: Callable[[str], Column], b: Callable[[str], Column], at: Column, params: DetectorParams, near_identical: bool) -> Column:
    """The exact predicates of two statements of one key of level ``at``: the longer one's level, and ``a`` the one that starts earlier."""
    cond = at == F.greatest(a("level"), b("level"))
    cond = cond & ((a("ps") < b("ps")) | ((a("ps") == b("ps")) & (a("invoice_id") < b("invoice_id"))))
    return cond & _overlap(a, b, params, near_identical, a("invoice_id") < b("invoice_id"))


def _by_id(a: Callable[[str], Column], b: Callable[[str], Column]) -> list[Column]:
    """Both statements' fields, those of the smaller id as ``a``."""
    first = a("invoice_id") < b("invoice_id")
    return [F.when(first if p == "a" else ~first, a(c)).otherwise(b(c)).alias(f"{p}_{c}") for p in "ab" for c in _COLS]


def _pairwise(statements: DataFrame, params: DetectorParams, near_identical: bool) -> DataFrame:
    """Pairs of customers with few statements."""
    return _side(statements, "a").join(_side(statements, "b"), (F.col("a_customer_id") == F.col("b_customer_id")) & _matches(params, near_identical)).select(
        *[f"{p}_{c}" for p in "ab" for c in _COLS])


def _placed(base: DataFrame, near_identical: bool, params: DetectorParams, together: bool = False) -> tuple[DataFrame, Column, list[str]]:
    """Statements with ``level``, once for each level ``at`` that they need; the bins they touch there; the keys by which they meet."""
    lo, hi = F.least("ps", "pe"), F.greatest("ps", "pe")
    occurring = base.agg(F.sort_array(F.collect_set(_level(lo, hi))).alias("levels")).scalar()  # a few numbers
    base = (base.repartition("customer_id") if together else base).withColumn("level", _level(lo, hi))
    placed = base.withColumn("at", F.explode(F.array_except(occurring, F.sequence(F.lit(-1), F.col("level") - 1))))
    banded = near_identical and params.amount_banding and params.tolerance_ratio < 1
    bins = F.sequence(_bin(lo, F.col("at")), _bin(hi, F.col("at")))
    return placed, bins, ["customer_id", "at", "bin", *(["band"] if banded else [])]


def _together(base: DataFrame, params: DetectorParams, near_identical: bool) -> DataFrame:
    """Pairs of customers that one task can hold: all rows of a statement are made, and meet, where its customer's lie.

    A statement's row in the bin and band of its start and amount (``own``) serves as the later one's of ``_binned``.
    """
    rows, bins, keys = _placed(base, near_identical, params, together=True)
    rows = rows.withColumn("bin", F.explode(bins))
    own = F.col("bin") == _bin(F.col("ps"), F.col("at"))
    if "band" in keys:
        rows = rows.withColumn("band", F.explode(_bands(F.col("amount_due"), params)))
        own = own & (F.col("band") == _band(F.col("amount_due"), params))
    shared = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter("_n > 1")
    met = shared.groupBy(*keys).agg(F.collect_list(F.struct(*_COLS, "level", own.alias("own"))).alias("_all"))
    later = met.select("at", "_all", F.explode(F.filter("_all", lambda x: x["own"])).alias("_b"))
    a, b = lambda c: F.col("_a")[c], lambda c: F.col("_b")[c]
    pairs = later.select("_b", F.explode(F.filter("_all", lambda x: _meet_once(lambda c: x[c], b, F.col("at"), params, near_identical))).alias("_a"))
    return pairs.select(*_by_id(a, b))


def _binned(base: DataFrame, params: DetectorParams, near_identical: bool) -> DataFrame:
    """Pairs by customer, level, bin and amount band, heavy keys in parts; from the rows of earlier (``a``) and later (``b``) start."""
    placed, bins, keys = _placed(base, near_identical, params)
    extra = ["level", "at", "bin"]
    a = _side(placed.withColumn("bin", F.explode(bins)), "a", *extra)
    b = _side(placed.withColumn("bin", _bin(F.col("ps"), F.col("at"))), "b", *extra)
    if "band" in keys:
        a = a.withColumn("a_band", F.explode(_bands(F.col("a_amount_due"), params)))
        b = b.withColumn("b_band", _band(F.col("b_amount_due"), params))
    a, b = in_parts(a, b, keys, params)
    cond = reduce(lambda x, y: x & y, [F.col(f"a_{k}") == F.col(f"b_{k}") for k in [*keys, "part"]])
    met = a.join(b, cond & _meet_once(_of("a"), _of("b"), F.col("a_at"), params, near_identical))
    return met.select(*_by_id(_of("a"), _of("b")))


def in_parts(a: DataFrame, b: DataFrame, keys: list[str], params: DetectorParams) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``part``: b rows of a heavy key (``b_``-prefixed ``keys``) dealt by hash, a rows repeated for each part.

    Only heavy keys are in the table that the sides meet, at most one for each ``heavy_key_rows`` rows of b; it is broadcast,
    so no side is shuffled for it.
    """
    of = lambda p: [f"{p}_{k}" for k in keys]
    sizes = b.groupBy(*of("b")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > params.heavy_key_rows)
    heavy = F.broadcast(sizes.select(*[F.col(f"b_{k}").alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / params.heavy_key_rows).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    meet = lambda df, p: df.join(heavy, reduce(lambda x, y: x & y, [F.col(f"{p}_{k}") == F.col(f"_{k}") for k in keys]), "left")
    a_parts = meet(a, "a").withColumn("a_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    b_parts = meet(b, "b").withColumn("b_part", F.pmod(F.xxhash64("b_invoice_id"), parts).cast("int"))
    return a_parts.select(*a.columns, "a_part"), b_parts.select(*b.columns, "b_part")


def overlap_counts(invoices: DataFrame) -> DataFrame:
    """``customer_id, invoice_id, overlapping``: how many other statements of the customer overlap each one.

    Statements without customer, start or end, or that end before they start, are left out.
    """
    periods = statement_periods(invoices).dropna(subset=["customer_id", "ps", "pe"]).filter("ps <= pe")
    marks = periods.select("customer_id", F.col("ps").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")).unionAll(
        periods.select("customer_id", F.col("pe").alias("day"), F.lit(0), F.lit(1)))
    days = marks.groupBy("customer_id", "day").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    w = Window.partitionBy("customer_id").orderBy("day")
    sums = days.select(
        F.col("customer_id").alias("c"), "day",
        F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("started"),
        F.coalesce(F.sum("ends").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ended"))
    at_end = sums.select(F.col("c").alias("_ce"), F.col("day").alias("_de"), "started")
    at_start = sums.select(F.col("c").alias("_cs"), F.col("day").alias("_ds"), "ended")
    both = periods.join(at_end, (F.col("customer_id") == F.col("_ce")) & (F.col("pe") == F.col("_de"))).join(
        at_start, (F.col("customer_id") == F.col("_cs")) & (F.col("ps") == F.col("_ds")))
    return both.select("customer_id", "invoice_id", (F.col("started") - F.col("ended") - 1).alias("overlapping"))
