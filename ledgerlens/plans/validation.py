"""Detector validation against labels, and data-quality checks.

Labels (a manifest) have one row per expected anomaly: ``defect_id, defect_family,
customer_id, affected_invoice_id ('' when the defect has no invoice), expected_rule,
expected_severity, injected_amount``.  A label is recalled when a flag of its rule
exists for its customer and, if it names an invoice, for that invoice.

Flags and labels are matched by key: counted by it where counts are asked for, and joined to a
*distinct* key set where rows are, so a customer with many flags and many labels never
produces a per-customer cross product.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import rule_dimension
from ledgerlens.functions.severity import severity_rank_col
from ledgerlens.params import FAMILY_RULE, SEVERITY_RANK


def manifest_shape(labels: DataFrame) -> DataFrame:
    """Per defect family: label count and labels whose rule is not the family's rule."""
    fam = labels.sparkSession.createDataFrame(
        sorted(FAMILY_RULE.items()), "defect_family string, family_rule int"
    )
    # The family map has five rows: broadcasting it is size-bounded by construction.
    j = labels.join(F.broadcast(fam), "defect_family", "left")
    return j.groupBy("defect_family").agg(
        F.count(F.lit(1)).alias("labels"),
        F.count_if(F.col("family_rule").isNull() | (F.col("family_rule") != F.col("expected_rule")))
        .cast("long").alias("rule_mismatches"),
    )


def _label_hits(labels: DataFrame, flags: DataFrame) -> DataFrame:
    """Labels with a boolean ``hit``."""
    by_cust = flags.select(F.col("customer_id").alias("_c"), F.col("rule_id").alias("_r")).distinct()
    by_inv = flags.filter(F.col("invoice_id").isNotNull()).select(
        F.col("customer_id").alias("_c2"), F.col("rule_id").alias("_r2"), F.col("invoice_id").alias("_i2")
    ).distinct()
    no_inv = labels.filter(F.col("affected_invoice_id") == "")
    with_inv = labels.filter(F.col("affected_invoice_id") != "")
    a = no_inv.join(
        by_cust, (F.col("customer_id") == F.col("_c")) & (F.col("expected_rule") == F.col("_r")), "left"
    ).withColumn("hit", F.col("_c").isNotNull()).drop("_c", "_r")
    b = with_inv.join(
        by_inv,
        (F.col("customer_id") == F.col("_c2")) & (F.col("expected_rule") == F.col("_r2"))
        & (F.col("affected_invoice_id") == F.col("_i2")),
        "left",
    ).withColumn("hit", F.col("_c2").isNotNull()).drop("_c2", "_r2", "_i2")
    return a.unionByName(b)


def _flag_hits(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Flags with a boolean ``hit`` (a label of its rule exists for it)."""
    k1 = labels.filter(F.col("affected_invoice_id") == "").select(
        F.col("customer_id").alias("_c"), F.col("expected_rule").alias("_r")
    ).distinct()
    k2 = labels.filter(F.col("affected_invoice_id") != "").select(
        F.col("customer_id").alias("_c2"), F.col("expected_rule").alias("_r2"),
        F.col("affected_invoice_id").alias("_i2"),
    ).distinct()
    j = flags.join(k1, (F.col("customer_id") == F.col("_c")) & (F.col("rule_id") == F.col("_r")), "left")
    j = j.join(
        k2,
        (F.col("customer_id") == F.col("_c2")) & (F.col("rule_id") == F.col("_r2"))
        & (F.col("invoice_id") == F.col("_i2")),
        "left",
    )
    return j.withColumn("hit", F.col("_c").isNotNull() | F.col("_c2").isNotNull()).drop(
        "_c", "_r", "_c2", "_r2", "_i2"
    )


def _keys(df: DataFrame, rule: str, invoice: str, *more: Column) -> DataFrame:
    """One row per (customer, rule, invoice or '') with the number of rows: what flags and labels are matched by."""
    return df.groupBy(F.col("customer_id").alias("c"), F.col(rule).alias("r"), F.coalesce(F.col(invoice), F.lit("")).alias("i")).agg(
        F.count(F.lit(1)).alias("n"), *more)


def detection_scorecard(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Per rule: expected, recalled, flagged, true flags, recall and precision.

    Flags and labels are counted by key before they meet, so no customer's rows are joined one by one.
    """
    flag_keys, label_keys = _keys(flags, "rule_id", "invoice_id"), _keys(labels, "expected_rule", "affected_invoice_id")
    named, open_ = label_keys.filter("i <> ''"), label_keys.filter("i = ''").drop("i")
    by_rule = lambda df, n, hits: df.groupBy(F.col("r").alias("rule_id")).agg(
        F.sum("n").alias(n), F.sum(F.when(F.col("hit"), F.col("n"))).alias(hits))
    yes = F.lit(True)
    found = named.join(flag_keys.select("c", "r", "i", yes.alias("hit")), ["c", "r", "i"], "left").drop("i").unionByName(
        open_.join(flag_keys.select("c", "r", yes.alias("hit")).distinct(), ["c", "r"], "left"))
    judged = flag_keys.join(named.select("c", "r", "i", yes.alias("by_invoice")), ["c", "r", "i"], "left").join(
        open_.select("c", "r", yes.alias("by_customer")), ["c", "r"], "left").withColumn("hit", F.coalesce("by_invoice", "by_customer"))
    dim = F.broadcast(rule_dimension(flags.sparkSession).select("rule_id"))  # five rows
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return dim.join(by_rule(found, "expected", "recalled"), "rule_id", "left").join(
        by_rule(judged, "flagged", "true_flags"), "rule_id", "left").select(
        "rule_id", *[z(c).alias(c) for c in ("expected", "recalled", "flagged", "true_flags")],
        F.try_divide(z("recalled").cast("double"), F.col("expected")).alias("recall"),
        F.try_divide(z("true_flags").cast("double"), F.col("flagged")).alias("precision"),
    )


def missed_defects(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels no flag recalls."""
    return _label_hits(labels, flags).filter(~F.col("hit")).drop("hit")


def false_positives(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Flags without a label."""
    return _flag_hits(flags, labels).filter(~F.col("hit")).drop("hit")


def severity_confusion(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels counted by (expected_rule, expected_severity, assigned_severity).

    The assigned severity of a (customer, rule, invoice) key is its most urgent flag;
    'missing' when the label is not recalled at that key.
    """
    names = {rank: name for name, rank in SEVERITY_RANK.items()}
    back: Column | None = None
    for rank, name in names.items():
        back = (F.when(F.col("_rank") == rank, F.lit(name)) if back is None
                else back.when(F.col("_rank") == rank, F.lit(name)))
    assigned = _keys(flags, "rule_id", "invoice_id", F.min(severity_rank_col("severity")).alias("_rank")).select(
        "c", "r", "i", back.otherwise(F.lit("unknown")).alias("assigned"))
    expected = labels.groupBy(F.col("customer_id").alias("c"), F.col("expected_rule").alias("r"), F.col("affected_invoice_id").alias("i"),
                              "expected_severity").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(assigned, ["c", "r", "i"], "left").groupBy(
        F.col("r").alias("expected_rule"), "expected_severity", F.coalesce("assigned", F.lit("missing")).alias("assigned_severity"),
    ).agg(F.sum("n").alias("labels"))


def set_diff(left: DataFrame, right: DataFrame, left_name: str = "left_only",
             right_name: str = "right_only") -> DataFrame:
    """Multiset difference both ways, tagged with ``side`` (empty when equal)."""
    return left.exceptAll(right).select(F.lit(left_name).alias("side"), "*").unionByName(
        right.exceptAll(left).select(F.lit(right_name).alias("side"), "*")
    )


def table_digest(df: DataFrame) -> DataFrame:
    """Order-insensitive one-row digest: row count and a sum of 64-bit row hashes."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("digest"))


def notice_set_diff(notices: DataFrame, labels: DataFrame) -> DataFrame:
    """Notice invoices against the invoices of allocation-defect labels."""
    n = notices.select(F.col("invoice_id").cast("string").alias("invoice_id"))
    m = labels.filter(F.col("defect_family") == "allocation").select(
        F.col("affected_invoice_id").alias("invoice_id")
    )
    return set_diff(n, m, "notice_only", "label_only")


def customers_by_rule_set(flags: DataFrame) -> DataFrame:
    """How many customers carry each exact set of rules (e.g. '1,3')."""
    per_customer = flags.groupBy("customer_id").agg(
        F.array_join(F.sort_array(F.collect_set(F.col("rule_id").cast("string"))), ",").alias("rule_set")
    )
    return per_customer.groupBy("rule_set").agg(F.count(F.lit(1)).alias("customers"))


def _checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate pass, then one row per check: ``check_name, violations``."""
    agg = df.agg(*[F.count_if(cond).cast("long").alias(name) for name, cond in checks.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return agg.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, violations)")


def flag_contract_checks(flags: DataFrame) -> DataFrame:
    return _checks(flags, {
        "flag_date_present": F.col("flag_date").isNull() | (F.trim(F.col("flag_date")) == ""),
        "invoice_missing_only_for_rule2": F.col("invoice_id").isNull() & (F.col("rule_id") != 2),
        "rule_id_known": F.col("rule_id").isNull() | ~F.col("rule_id").isin(1, 2, 3, 4, 5),
        "severity_known": F.col("severity").isNull() | ~F.col("severity").isin(*SEVERITY_RANK),
    })


@dataclass(frozen=True)
class Key:
    """A table's key column; ``check`` counts its rows beyond the first of every key."""

    table: str
    column: str
    check: str


@dataclass(frozen=True)
class Reference:
    """A column of ``table`` that names a key of ``parent``; ``check`` counts the rows whose key the parent lacks."""

    table: str
    column: str
    parent: str
    check: str


BILLING_KEYS = (
    Key("customers", "customer_id", "customers_pk_unique"), Key("ledger_entries", "entry_id", "ledger_pk_unique"),
    Key("invoices", "invoice_id", "invoices_pk_unique"), Key("invoice_allocations", "allocation_id", "allocations_pk_unique"),
)
BILLING_REFERENCES = (
    Reference("ledger_entries", "customer_id", "customers", "ledger_customer_fk"),
    Reference("invoices", "customer_id", "customers", "invoice_customer_fk"),
    Reference("invoice_allocations", "entry_id", "ledger_entries", "allocation_entry_fk"),
    Reference("invoice_allocations", "invoice_id", "invoices", "allocation_invoice_fk"),
)
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def integrity_checks(tables: dict[str, DataFrame], keys: Sequence[Key], references: Sequence[Reference],
                     conditions: dict[str, dict[str, Column]]) -> DataFrame:
    """``check_name, violations`` of keys, references and row conditions (by table), from one scan of every table.

    Every row gives its key, the keys it refers to and the conditions it breaks; these are counted by key in one
    shuffle, with partial counts before it, so a hot key is one row of every task.  Keys may be sparse and of any type:
    whole numbers stay numbers, others are compared as text.  A null key is not a key of its table; a null reference
    has no parent (as NOT EXISTS would say).  Repeats of a parent's key do not repeat its children.
    """
    types = {name: dict(df.dtypes) for name, df in tables.items()}
    slots: dict[Reference, int] = {}
    for r in references:
        slots[r] = sum(o.parent == r.parent for o in slots)
    domain = {k.table: i for i, k in enumerate(keys)}
    whole = {k.table: all(types[t][c] in _INTEGERS for t, c in
                          [(k.table, k.column), *((r.table, r.column) for r in references if r.parent == k.table)]) for k in keys}
    names = [(table, check) for table, checks in conditions.items() for check in checks]
    broken = len(keys)  # the domain of conditions, keyed by their number

    def part(at: int, slot: int, number: Column, text: Column) -> Column:
        return F.struct(F.lit(at).alias("domain"), F.lit(slot).alias("slot"), number.cast("long").alias("number"), text.cast("string").alias("text"))

    def of_key(at: str, slot: int, column: str) -> Column:
        c, none = F.col(column), F.lit(None)
        return part(domain[at], slot, *((c, none) if whole[at] else (none, c)))

    def of_table(table: str) -> DataFrame:
        parts = [F.when(F.col(k.column).isNotNull(), of_key(k.table, -1, k.column)) for k in keys if k.table == table]
        parts += [of_key(r.parent, slots[r], r.column) for r in references if r.table == table]
        parts += [F.when(conditions[t][check], part(broken, -1, F.lit(i), F.lit(None))) for i, (t, check) in enumerate(names) if t == table]
        return tables[table].select(F.inline(F.array_compact(F.array(*parts))))

    used = {k.table for k in keys} | {r.table for r in references} | set(conditions)
    rows = reduce(lambda a, b: a.unionByName(b), [of_table(t) for t in tables if t in used])
    width = 1 + max(slots.values(), default=-1)
    counted = rows.groupBy("domain", "number", "text").agg(
        F.count_if(F.col("slot") == -1).alias("own"), *[F.count_if(F.col("slot") == s).alias(f"by_{s}") for s in range(width)])
    of = lambda at: F.col("domain") == at
    violations = {k.check: F.when(of(domain[k.table]) & (F.col("own") > 1), F.col("own") - 1) for k in keys}
    violations |= {r.check: F.when(of(domain[r.parent]) & (F.col("own") == 0), F.col(f"by_{slots[r]}")) for r in references}
    violations |= {check: F.when(of(broken) & (F.col("number") == i), F.col("own")) for i, (_, check) in enumerate(names)}
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for name, c in violations.items()])
    return total.selectExpr(f"stack({len(violations)}, {', '.join(f"'{n}', `{n}`" for n in violations)}) as (check_name, violations)")


def bronze_quality_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary-key uniqueness, foreign keys, amount sign by entry type, period order; every table is read once."""
    return integrity_checks(tables, BILLING_KEYS, BILLING_REFERENCES, {
        "ledger_entries": {"amount_sign_by_type": (
            ((F.col("type") == "invoice_debit") & (F.col("amount") >= 0))
            | (F.col("type").isin("payment", "credit") & (F.col("amount") <= 0))
            | F.col("amount").isNull()
        )},
        "invoices": {"period_start_before_end": F.col("statement_period_start") > F.col("statement_period_end")},
    })
