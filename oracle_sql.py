"""Independent DuckDB formulations of every registered query (the correctness oracle).

They are written the plain way on purpose (correlated sums for as-of balances, one
LAG window per customer, an all-pairs self-join for duplicates) so they check the
Spark plans, which compute the same results with bounded windows and binned joins.
Money leaves as DOUBLE and dates as ISO text, exactly as ``__spark_entry__`` emits.
"""

from __future__ import annotations

# Thresholds of the test-table parameterisation (see ledgerlens.params.TESTDATA_PARAMS)
# and of the what-if run of the table diff.
GRACE = 7
ORPHAN = 30
GAP = 3
ESC = "100000.00"
SUPPLIES_ESC = "50000.00"
WHATIF_GRACE = 14

_KEY = "concat_ws('-', '{p}' || CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), " \
       "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))"


def _mapping() -> list[tuple[str, str]]:
    return [
        ("invoices", """
  SELECT o_orderkey AS invoice_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS statement_period_start,
         CAST(o_orderdate AS DATE) + 89 AS statement_period_end,
         CAST(o_orderdate AS DATE) + 94 AS due_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount_due,
         CAST(o_orderdate AS DATE) AS issued_date
  FROM orders"""),
        ("ledger_entries", f"""
  SELECT 'D' || CAST(o_orderkey AS VARCHAR) AS entry_id, o_custkey AS customer_id,
         'invoice_debit' AS type, -CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(o_orderdate AS DATE) AS effective_date, 'invoice' AS source, 'settled' AS status
  FROM orders
  UNION ALL
  SELECT {_KEY.format(p='P')}, o_custkey,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'credit' ELSE 'payment' END,
         CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_shipdate AS DATE),
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'goodwill' ELSE 'direct_debit' END,
         CASE WHEN l_returnflag = 'R' THEN 'dishonoured' ELSE 'settled' END
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
        ("invoice_allocations", f"""
  SELECT {_KEY.format(p='A')} AS allocation_id, {_KEY.format(p='P')} AS entry_id,
         l_orderkey AS invoice_id,
         CAST(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2))
                   ELSE round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
              END AS DECIMAL(18,2)) AS amount_allocated,
         CAST(l_shipdate AS DATE) AS allocated_date
  FROM lineitem
  WHERE l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F')"""),
        ("customers", """
  SELECT c_custkey AS customer_id, c_mktsegment AS plan_id, CAST(NULL AS DATE) AS signup_date,
         'active' AS status
  FROM customer"""),
        ("valid", "SELECT * FROM ledger_entries WHERE status <> 'dishonoured'"),
    ]


def _silver(grace: int, sfx: str = "") -> list[tuple[str, str]]:
    return [
        (f"at_sent{sfx}", f"""
  SELECT i.invoice_id, i.customer_id, i.amount_due, i.due_date + {grace} AS sent_date,
         COALESCE(SUM(CASE WHEN a.allocated_date <= i.due_date + {grace} THEN a.amount_allocated END), 0)
           AS allocated_total_at_sent
  FROM invoices i LEFT JOIN invoice_allocations a ON a.invoice_id = i.invoice_id
  GROUP BY i.invoice_id, i.customer_id, i.amount_due, i.due_date"""),
        (f"notices{sfx}", f"""
  SELECT n.*, COALESCE(n.bal, 0) AS balance_at_sent, COALESCE(n.bal, 0) >= 0 AS in_credit
  FROM (SELECT s.*, (SELECT SUM(v.amount) FROM valid v
                     WHERE v.customer_id = s.customer_id AND v.effective_date <= s.sent_date) AS bal
        FROM at_sent{sfx} s WHERE s.allocated_total_at_sent < s.amount_due) n"""),
    ]


def _supplies() -> list[tuple[str, str]]:
    """The second mapping: each line item a statement of its supplier."""
    part = "FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"
    pays = "CAST(l_shipdate AS DATE) + 10 * l_linenumber"
    price, net = "CAST(l_extendedprice AS DECIMAL(18,2))", \
        "round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)"
    return [
        ("invoices", f"""
  SELECT {_KEY.format(p='')} AS invoice_id, l_suppkey AS customer_id, CAST(l_shipdate AS DATE) AS statement_period_start,
         CAST(l_shipdate AS DATE) + COALESCE(p_size, 0) AS statement_period_end,
         CAST(l_shipdate AS DATE) + 14 + COALESCE(p_size, 0) AS due_date,
         {price} AS amount_due, CAST(l_shipdate AS DATE) AS issued_date {part}"""),
        ("ledger_entries", f"""
  SELECT {_KEY.format(p='D')} AS entry_id, l_suppkey AS customer_id, 'invoice_debit' AS type, -{price} AS amount,
         CAST(l_shipdate AS DATE) AS effective_date, 'invoice' AS source, 'settled' AS status
  FROM lineitem
  UNION ALL
  SELECT {_KEY.format(p='P')}, l_suppkey, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'credit' ELSE 'payment' END,
         {price}, {pays}, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'goodwill' ELSE 'direct_debit' END,
         CASE WHEN l_returnflag = 'R' THEN 'dishonoured' ELSE 'settled' END
  FROM lineitem"""),
        ("invoice_allocations", f"""
  SELECT {_KEY.format(p='A')} AS allocation_id, {_KEY.format(p='P')} AS entry_id, {_KEY.format(p='')} AS invoice_id,
         CAST(CASE WHEN l_returnflag = 'A' THEN {price} ELSE {net} END AS DECIMAL(18,2)) AS amount_allocated,
         {pays} AS allocated_date
  FROM lineitem
  WHERE l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F')"""),
        ("customers", """
  SELECT s_suppkey AS customer_id, n_name AS plan_id, CAST(NULL AS DATE) AS signup_date,
         CASE WHEN s_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey"""),
        ("valid", "SELECT * FROM ledger_entries WHERE status <> 'dishonoured'"),
    ]


def _rules(sfx: str, orphan: int, gap: int, esc: str, invoice_of: str = "^P([0-9]+)-") -> list[tuple[str, str]]:
    flag_cols = "flag_id, rule_id, customer_id, invoice_id, amount, severity, flag_date, explanation"
    return [
        (f"r1{sfx}", f"""
  SELECT 'R1_' || CAST(invoice_id AS VARCHAR) AS flag_id, 1 AS rule_id,
         CAST(customer_id AS VARCHAR) AS customer_id, CAST(invoice_id AS VARCHAR) AS invoice_id,
         CAST(amount_due AS DECIMAL(18,2)) AS amount,
         CASE WHEN amount_due - allocated_total_at_sent > {esc} THEN 'critical' ELSE 'high' END AS severity,
         strftime(sent_date, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Wrongful arrears notice: invoice ', CAST(invoice_id AS VARCHAR), ' shown ',
                   CAST(CAST(amount_due - allocated_total_at_sent AS DECIMAL(18,2)) AS VARCHAR),
                   ' under-allocated at ', CAST(sent_date AS VARCHAR), ' while account balance ',
                   CAST(CAST(balance_at_sent AS DECIMAL(18,2)) AS VARCHAR), ' was in credit.') AS explanation
  FROM notices WHERE in_credit"""),
        (f"r2{sfx}", f"""
  SELECT 'R2_' || e.entry_id AS flag_id, 2 AS rule_id, CAST(e.customer_id AS VARCHAR) AS customer_id,
         CAST(NULL AS VARCHAR) AS invoice_id, CAST(e.amount AS DECIMAL(18,2)) AS amount,
         'warning' AS severity, strftime(e.effective_date, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Orphaned credit ', e.entry_id, ': ', CAST(CAST(e.amount AS DECIMAL(18,2)) AS VARCHAR),
                   ' unapplied for ',
                   CAST(CAST((SELECT max(due_date) FROM invoices) - e.effective_date AS INTEGER) AS VARCHAR),
                   ' days.') AS explanation
  FROM valid e
  LEFT JOIN (SELECT entry_id, SUM(amount_allocated) AS tot FROM invoice_allocations GROUP BY entry_id) t
         ON t.entry_id = e.entry_id
  WHERE e.type IN ('payment', 'credit')
    AND COALESCE(t.tot, 0) < e.amount
    AND (SELECT max(due_date) FROM invoices) - e.effective_date > {orphan}"""),
        (f"r3{sfx}", f"""
  SELECT 'R3_' || CAST(invoice_id AS VARCHAR) AS flag_id, 3 AS rule_id,
         CAST(customer_id AS VARCHAR) AS customer_id, CAST(invoice_id AS VARCHAR) AS invoice_id,
         CAST(0 AS DECIMAL(18,2)) AS amount, 'medium' AS severity,
         strftime(statement_period_start, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Statement continuity break: ', CAST(gap_days AS VARCHAR), ' day gap before invoice ',
                   CAST(invoice_id AS VARCHAR), '.') AS explanation
  FROM (SELECT *, CAST(statement_period_start - LAG(statement_period_end) OVER (
                     PARTITION BY customer_id ORDER BY statement_period_start, invoice_id) AS INTEGER) AS gap_days
        FROM invoices) s
  WHERE gap_days > {gap}"""),
        (f"r4{sfx}", f"""
  SELECT 'R4_' || entry_id AS flag_id, 4 AS rule_id, CAST(customer_id AS VARCHAR) AS customer_id,
         regexp_extract(entry_id, '{invoice_of}', 1) AS invoice_id, CAST(amount AS DECIMAL(18,2)) AS amount,
         'critical' AS severity, strftime(effective_date, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Dishonoured debit ', entry_id, ' (', CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR),
                   ') with no cause: balance ', CAST(CAST(balance AS DECIMAL(18,2)) AS VARCHAR),
                   ' pre-debit.') AS explanation
  FROM dishonour_bal WHERE balance >= 0"""),
        (f"r5{sfx}", f"""
  SELECT 'R5_' || CAST(b.invoice_id AS VARCHAR) AS flag_id, 5 AS rule_id,
         CAST(b.customer_id AS VARCHAR) AS customer_id, CAST(b.invoice_id AS VARCHAR) AS invoice_id,
         CAST(b.amount_due AS DECIMAL(18,2)) AS amount,
         CASE WHEN b.amount_due > {esc} THEN 'high' ELSE 'medium' END AS severity,
         strftime(b.statement_period_start, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Duplicate invoice ', CAST(b.invoice_id AS VARCHAR), ' overlaps ',
                   CAST(a.invoice_id AS VARCHAR), ' with near-identical amount.') AS explanation
  FROM invoices a JOIN invoices b
    ON a.customer_id = b.customer_id AND a.invoice_id < b.invoice_id
   AND a.statement_period_start <= b.statement_period_end
   AND b.statement_period_start <= a.statement_period_end
   AND abs(a.amount_due - b.amount_due) <= greatest(1.00, 0.01 * a.amount_due)"""),
        (f"flags{sfx}", f"""
  SELECT {flag_cols} FROM r1{sfx} UNION ALL SELECT {flag_cols} FROM r2{sfx}
  UNION ALL SELECT {flag_cols} FROM r3{sfx} UNION ALL SELECT {flag_cols} FROM r4{sfx}
  UNION ALL SELECT {flag_cols} FROM r5{sfx}"""),
    ]


_DISHONOUR_BAL = ("dishonour_bal", """
  SELECT d.*, COALESCE((SELECT SUM(v.amount) FROM valid v
                        WHERE v.customer_id = d.customer_id AND v.effective_date <= d.effective_date), 0) AS balance
  FROM ledger_entries d WHERE d.status = 'dishonoured'""")


def _shared() -> list[tuple[str, str]]:
    ctes = [*_mapping(), *_silver(GRACE), _DISHONOUR_BAL]
    ctes += _rules("", ORPHAN, GAP, ESC)
    family = "CASE {} WHEN 1 THEN 'allocation' WHEN 2 THEN 'stale_unswept_credit' WHEN 3 THEN 'statement_gap' " \
             "WHEN 4 THEN 'dishonour' ELSE 'duplicate_invoice' END"
    ctes.append(("labels", f"""
  SELECT 'L_' || flag_id AS defect_id, {family.format('rule_id')} AS defect_family,
         customer_id, COALESCE(invoice_id, '') AS affected_invoice_id, rule_id AS expected_rule,
         CASE WHEN right(COALESCE(invoice_id, customer_id), 1) = '5' THEN 'critical' ELSE severity END AS expected_severity,
         amount AS injected_amount
  FROM flags WHERE right(COALESCE(invoice_id, customer_id), 1) <> CASE rule_id WHEN 2 THEN '3' ELSE '7' END
  UNION ALL
  SELECT 'X_' || CAST(invoice_id AS VARCHAR), {family.format('r')}, CAST(customer_id AS VARCHAR),
         CASE WHEN r = 2 THEN '' ELSE CAST(invoice_id AS VARCHAR) END,
         CAST(CASE WHEN invoice_id % 970 = 0 THEN r % 5 + 1 ELSE r END AS INTEGER), 'high', amount_due
  FROM (SELECT *, CAST((invoice_id // 97) % 5 + 1 AS INTEGER) AS r FROM invoices WHERE invoice_id % 97 = 0) x"""))
    ctes += _silver(WHATIF_GRACE, "_whatif")
    return ctes


def _with(final: str, ctes: list[tuple[str, str]] | None = None) -> str:
    ctes = ctes or _shared()
    body = ",\n".join(f"{name} AS ({q}\n)" for name, q in ctes)
    return f"WITH {body}\n{final}"


def _dbl(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c}"


def _iso(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {alias or c}"


FLAG_OUT = ("flag_id, rule_id, customer_id, invoice_id, CAST(amount AS DOUBLE) AS amount, severity, "
            "flag_date, explanation")

SEV_RANK = "CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'warning' THEN 3 ELSE 4 END"
RULE_DIM = ("(VALUES (1, 'R1 wrongful notice'), (2, 'R2 orphaned credit'), (3, 'R3 statement gap'), "
            "(4, 'R4 dishonour'), (5, 'R5 duplicate invoice')) AS d(rule_id, rule_label)")


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ent = f"entry_id, customer_id, type, {_dbl('amount')}, {_iso('effective_date')}, source, status"
    supplies = [*_supplies(), *_silver(GRACE), _DISHONOUR_BAL, *_rules("", ORPHAN, GAP, SUPPLIES_ESC, "^P(.+)$")]
    for prefix, ctes in (("billing", _shared()), ("supplies", supplies)):
        q[f"{prefix}_customers"] = _with(f"SELECT customer_id, plan_id, {_iso('signup_date')}, status FROM customers", ctes)
        q[f"{prefix}_invoices"] = _with(
            "SELECT invoice_id, customer_id, " + ", ".join(
                _iso(c) for c in ["statement_period_start", "statement_period_end", "due_date"]
            ) + f", {_dbl('amount_due')}, {_iso('issued_date')} FROM invoices", ctes)
        q[f"{prefix}_ledger"] = _with(f"SELECT {ent} FROM ledger_entries", ctes)
        q[f"{prefix}_allocations"] = _with(
            f"SELECT allocation_id, entry_id, invoice_id, {_dbl('amount_allocated')}, {_iso('allocated_date')} "
            "FROM invoice_allocations", ctes)
    q["supplies_flagged_accounts"] = _with(f"SELECT {FLAG_OUT} FROM flags", supplies)
    q["valid_ledger"] = _with(f"SELECT {ent} FROM valid")
    q["dishonoured_entries"] = _with(f"SELECT {ent} FROM ledger_entries WHERE status = 'dishonoured'")
    q["credit_candidates"] = _with(f"SELECT {ent} FROM valid WHERE type IN ('payment', 'credit')")
    at = (f"invoice_id, customer_id, {_dbl('amount_due')}, {_iso('sent_date')}, "
          f"{_dbl('allocated_total_at_sent')}")
    q["allocated_at_sent"] = _with(f"SELECT {at} FROM at_sent")
    q["under_allocated_invoices"] = _with(f"SELECT {at} FROM at_sent WHERE allocated_total_at_sent < amount_due")
    notice = (f"customer_id, invoice_id, {_dbl('amount_due')}, {_iso('sent_date')}, "
              f"{_dbl('allocated_total_at_sent')}, {_dbl('balance_at_sent')}, in_credit")
    q["naive_notices"] = _with(f"SELECT {notice} FROM notices")
    q["balance_asof"] = _with("""
SELECT t.customer_id, strftime(t.d, '%Y-%m-%d') AS date,
       CAST((SELECT SUM(v.amount) FROM valid v WHERE v.customer_id = t.customer_id AND v.effective_date <= t.d)
            AS DOUBLE) AS running_balance
FROM (SELECT DISTINCT customer_id, due_date + 7 AS d FROM invoices) t""")
    q["running_balance"] = _with("""
SELECT customer_id, strftime(effective_date, '%Y-%m-%d') AS effective_date, entry_id,
       CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY effective_date, entry_id) AS DOUBLE) AS running_balance
FROM valid""")
    q["end_of_day_balance"] = _with("""
SELECT customer_id, strftime(effective_date, '%Y-%m-%d') AS effective_date,
       CAST(day_amount AS DOUBLE) AS day_amount,
       CAST(SUM(day_amount) OVER (PARTITION BY customer_id ORDER BY effective_date) AS DOUBLE) AS balance
FROM (SELECT customer_id, effective_date, SUM(amount) AS day_amount FROM valid GROUP BY 1, 2) d""")
    q["account_balance"] = _with("""
SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS balance,
       strftime(max(effective_date), '%Y-%m-%d') AS last_entry_date
FROM valid GROUP BY customer_id""")
    q["overpaid_accounts"] = _with("""
SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS balance,
       strftime(max(effective_date), '%Y-%m-%d') AS last_entry_date
FROM valid GROUP BY customer_id HAVING SUM(amount) > 0""")
    q["allocated_per_entry"] = _with(
        "SELECT entry_id, CAST(SUM(amount_allocated) AS DOUBLE) AS allocated_total "
        "FROM invoice_allocations GROUP BY entry_id")
    q["allocated_per_invoice"] = _with(
        "SELECT invoice_id, CAST(SUM(amount_allocated) AS DOUBLE) AS allocated_total "
        "FROM invoice_allocations GROUP BY invoice_id")
    q["asof_date"] = _with("SELECT strftime(max(due_date), '%Y-%m-%d') AS asof_date FROM invoices")
    q["entry_residuals"] = _with("""
SELECT e.entry_id, e.customer_id, strftime(e.effective_date, '%Y-%m-%d') AS effective_date,
       CAST(e.amount AS DOUBLE) AS amount, CAST(COALESCE(t.tot, 0) AS DOUBLE) AS allocated_total,
       CAST(e.amount - COALESCE(t.tot, 0) AS DOUBLE) AS residual
FROM valid e
LEFT JOIN (SELECT entry_id, SUM(amount_allocated) AS tot FROM invoice_allocations GROUP BY entry_id) t
       ON t.entry_id = e.entry_id
WHERE e.type IN ('payment', 'credit') AND COALESCE(t.tot, 0) < e.amount""")
    q["overlapping_statements"] = _with("""
SELECT a.customer_id, a.invoice_id, count(b.invoice_id) AS overlapping
FROM invoices a LEFT JOIN invoices b
  ON a.customer_id = b.customer_id AND a.invoice_id <> b.invoice_id
 AND a.statement_period_start <= b.statement_period_end AND b.statement_period_start <= a.statement_period_end
GROUP BY a.customer_id, a.invoice_id""")
    for k, cte in [("rule1_wrongful_notice", "r1"), ("rule2_orphaned_credit", "r2"),
                   ("rule3_statement_gap", "r3"), ("rule4_dishonour", "r4"),
                   ("rule5_duplicate_invoice", "r5"), ("flagged_accounts", "flags")]:
        q[k] = _with(f"SELECT {FLAG_OUT} FROM {cte}")
    q["rule4_dishonour_strict"] = _with(f"""
SELECT {FLAG_OUT} FROM (
  SELECT 'R4_' || entry_id AS flag_id, 4 AS rule_id, CAST(customer_id AS VARCHAR) AS customer_id,
         regexp_extract(entry_id, '^P([0-9]+)-', 1) AS invoice_id, CAST(amount AS DECIMAL(18,2)) AS amount,
         'critical' AS severity, strftime(effective_date, '%Y-%m-%d') AS flag_date,
         concat_ws('', 'Dishonoured debit ', entry_id, ' (', CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR),
                   ') with no cause: balance ', CAST(CAST(balance AS DECIMAL(18,2)) AS VARCHAR),
                   ' pre-debit.') AS explanation
  FROM dishonour_bal WHERE balance >= amount) s""")
    seq = """(SELECT *, LAG(statement_period_end) OVER w AS prev_end,
                 MAX(statement_period_end) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_end
          FROM invoices WINDOW w AS (PARTITION BY customer_id ORDER BY statement_period_start, invoice_id)) s"""
    q["coverage_gaps"] = _with(f"""
SELECT customer_id, invoice_id, strftime(statement_period_start, '%Y-%m-%d') AS ps,
       strftime(prev_max_end, '%Y-%m-%d') AS prev_max_end,
       CAST(statement_period_start - prev_max_end AS INTEGER) AS gap_days
FROM {seq} WHERE statement_period_start - prev_max_end > {GAP}""")
    q["continuity_classes"] = _with(f"""
SELECT customer_id, invoice_id, strftime(statement_period_start, '%Y-%m-%d') AS ps,
       strftime(prev_end, '%Y-%m-%d') AS prev_end,
       CAST(statement_period_start - prev_end AS INTEGER) AS gap_days,
       CASE WHEN prev_end IS NULL THEN 'first'
            WHEN statement_period_start - prev_end = 1 THEN 'contiguous'
            WHEN statement_period_start - prev_end > 1 THEN 'gap' ELSE 'overlap' END AS continuity
FROM {seq}""")
    q["notice_classes"] = _with(
        f"SELECT {notice}, CASE WHEN in_credit THEN 'wrongful' ELSE 'legitimate' END AS notice_class FROM notices")
    q["reconciliation_mismatch"] = _with("""
SELECT customer_id, invoice_id, strftime(sent_date, '%Y-%m-%d') AS sent_date,
       CAST(amount_due - allocated_total_at_sent AS DOUBLE) AS allocation_shortfall,
       CAST(balance_at_sent AS DOUBLE) AS ledger_balance
FROM notices WHERE in_credit""")
    q["invoice_position"] = _with(f"""
SELECT s.invoice_id, s.customer_id, CAST(s.amount_due AS DOUBLE) AS amount_due,
       strftime(s.sent_date - {GRACE}, '%Y-%m-%d') AS due_date, strftime(s.sent_date, '%Y-%m-%d') AS sent_date,
       CAST(COALESCE((SELECT SUM(a.amount_allocated) FROM invoice_allocations a WHERE a.invoice_id = s.invoice_id), 0)
            AS DOUBLE) AS allocated_total,
       CAST(s.allocated_total_at_sent AS DOUBLE) AS allocated_total_at_sent,
       CAST(COALESCE((SELECT SUM(v.amount) FROM valid v WHERE v.customer_id = s.customer_id
                      AND v.effective_date <= s.sent_date - {GRACE}), 0) AS DOUBLE) AS balance_at_due,
       s.allocated_total_at_sent < s.amount_due AS notice_sent
FROM at_sent s""")
    q["severity_matrix"] = _with("SELECT rule_id, severity, count(*) AS flags FROM flags GROUP BY 1, 2")
    q["flags_by_rule"] = _with(f"""
SELECT d.rule_id, d.rule_label, COALESCE(c.n, 0) AS flags
FROM {RULE_DIM} LEFT JOIN (SELECT rule_id, count(*) AS n FROM flags GROUP BY rule_id) c ON c.rule_id = d.rule_id""")
    q["flags_by_month"] = _with("SELECT substr(flag_date, 1, 7) AS month, count(*) AS flags FROM flags GROUP BY 1")
    q["flag_drilldown"] = _with(f"""
SELECT f.customer_id, f.rule_id, d.rule_label, f.severity, CAST(f.amount AS DOUBLE) AS amount,
       COALESCE(f.invoice_id, '') AS invoice_id, f.flag_date, f.explanation
FROM flags f JOIN {RULE_DIM} ON d.rule_id = f.rule_id""")
    # ---- validation: detector against labels that differ from it in known ways
    q["detection_scorecard"] = _with(f"""
SELECT d.rule_id, COALESCE(l.expected, 0) AS expected, COALESCE(l.recalled, 0) AS recalled,
       COALESCE(f.flagged, 0) AS flagged, COALESCE(f.true_flags, 0) AS true_flags,
       CAST(l.recalled AS DOUBLE) / NULLIF(l.expected, 0) AS recall,
       CAST(f.true_flags AS DOUBLE) / NULLIF(f.flagged, 0) AS precision
FROM {RULE_DIM}
LEFT JOIN (SELECT expected_rule AS rule_id, count(*) AS expected, count(*) FILTER (WHERE hit) AS recalled
           FROM (SELECT m.expected_rule, EXISTS (SELECT 1 FROM flags f WHERE f.customer_id = m.customer_id
                      AND f.rule_id = m.expected_rule
                      AND (m.affected_invoice_id = '' OR f.invoice_id = m.affected_invoice_id)) AS hit
                 FROM labels m) x GROUP BY 1) l ON l.rule_id = d.rule_id
LEFT JOIN (SELECT rule_id, count(*) AS flagged, count(*) FILTER (WHERE hit) AS true_flags
           FROM (SELECT f.rule_id, EXISTS (SELECT 1 FROM labels m WHERE f.customer_id = m.customer_id
                      AND f.rule_id = m.expected_rule
                      AND (m.affected_invoice_id = '' OR f.invoice_id = m.affected_invoice_id)) AS hit
                 FROM flags f) y GROUP BY 1) f ON f.rule_id = d.rule_id""")
    q["missed_defects"] = _with("""
SELECT defect_id, defect_family, customer_id, affected_invoice_id, expected_rule, expected_severity,
       CAST(injected_amount AS DOUBLE) AS injected_amount
FROM labels m WHERE NOT EXISTS (SELECT 1 FROM flags f WHERE f.customer_id = m.customer_id
      AND f.rule_id = m.expected_rule AND (m.affected_invoice_id = '' OR f.invoice_id = m.affected_invoice_id))""")
    q["false_positives"] = _with(f"""
SELECT {FLAG_OUT} FROM flags f WHERE NOT EXISTS (SELECT 1 FROM labels m WHERE f.customer_id = m.customer_id
      AND f.rule_id = m.expected_rule AND (m.affected_invoice_id = '' OR f.invoice_id = m.affected_invoice_id))""")
    q["severity_confusion"] = _with(f"""
SELECT m.expected_rule, m.expected_severity, COALESCE(k.assigned, 'missing') AS assigned_severity,
       count(*) AS labels
FROM labels m LEFT JOIN (
    SELECT customer_id, rule_id, COALESCE(invoice_id, '') AS inv,
           CASE min({SEV_RANK}) WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium'
                                WHEN 3 THEN 'warning' ELSE 'unknown' END AS assigned
    FROM flags GROUP BY 1, 2, 3) k
  ON k.customer_id = m.customer_id AND k.rule_id = m.expected_rule AND k.inv = m.affected_invoice_id
GROUP BY 1, 2, 3""")
    q["manifest_shape"] = _with("""
SELECT m.defect_family, count(*) AS labels,
       count(*) FILTER (WHERE f.rule IS NULL OR f.rule <> m.expected_rule) AS rule_mismatches
FROM labels m LEFT JOIN (VALUES ('allocation', 1), ('stale_unswept_credit', 2), ('statement_gap', 3),
                                ('dishonour', 4), ('duplicate_invoice', 5)) AS f(family, rule)
  ON f.family = m.defect_family
GROUP BY m.defect_family""")
    q["notice_set_diff"] = _with("""
SELECT 'notice_only' AS side, CAST(invoice_id AS VARCHAR) AS invoice_id FROM
  (SELECT CAST(invoice_id AS VARCHAR) AS invoice_id FROM notices
   EXCEPT ALL SELECT affected_invoice_id FROM labels WHERE defect_family = 'allocation') x
UNION ALL
SELECT 'label_only', invoice_id FROM
  (SELECT affected_invoice_id AS invoice_id FROM labels WHERE defect_family = 'allocation'
   EXCEPT ALL SELECT CAST(invoice_id AS VARCHAR) FROM notices) y""")
    q["customers_by_rule_set"] = _with("""
SELECT rule_set, count(*) AS customers FROM (
  SELECT customer_id, string_agg(DISTINCT CAST(rule_id AS VARCHAR), ',' ORDER BY CAST(rule_id AS VARCHAR)) AS rule_set
  FROM flags GROUP BY customer_id) s GROUP BY rule_set""")
    q["flag_contract_checks"] = _with("""
SELECT 'flag_date_present' AS check_name, count(*) FILTER (WHERE flag_date IS NULL OR trim(flag_date) = '') AS violations FROM flags
UNION ALL SELECT 'invoice_missing_only_for_rule2', count(*) FILTER (WHERE invoice_id IS NULL AND rule_id <> 2) FROM flags
UNION ALL SELECT 'rule_id_known', count(*) FILTER (WHERE rule_id IS NULL OR rule_id NOT IN (1, 2, 3, 4, 5)) FROM flags
UNION ALL SELECT 'severity_known', count(*) FILTER (WHERE severity IS NULL OR severity NOT IN ('critical', 'high', 'medium', 'warning')) FROM flags""")
    q["bronze_quality_checks"] = _with("""
SELECT 'customers_pk_unique' AS check_name,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations FROM (SELECT customer_id, count(*) AS n FROM customers WHERE customer_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) x
UNION ALL SELECT 'ledger_pk_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT entry_id, count(*) AS n FROM ledger_entries WHERE entry_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) x
UNION ALL SELECT 'invoices_pk_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT invoice_id, count(*) AS n FROM invoices WHERE invoice_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) x
UNION ALL SELECT 'allocations_pk_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT allocation_id, count(*) AS n FROM invoice_allocations WHERE allocation_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) x
UNION ALL SELECT 'ledger_customer_fk', count(*) FROM ledger_entries e WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = e.customer_id)
UNION ALL SELECT 'invoice_customer_fk', count(*) FROM invoices i WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = i.customer_id)
UNION ALL SELECT 'allocation_entry_fk', count(*) FROM invoice_allocations a WHERE NOT EXISTS (SELECT 1 FROM ledger_entries e WHERE e.entry_id = a.entry_id)
UNION ALL SELECT 'allocation_invoice_fk', count(*) FROM invoice_allocations a WHERE NOT EXISTS (SELECT 1 FROM invoices i WHERE i.invoice_id = a.invoice_id)
UNION ALL SELECT 'amount_sign_by_type', count(*) FROM ledger_entries WHERE (type = 'invoice_debit' AND amount >= 0) OR (type IN ('payment', 'credit') AND amount <= 0) OR amount IS NULL
UNION ALL SELECT 'period_start_before_end', count(*) FROM invoices WHERE statement_period_start > statement_period_end""")
    q["table_diff"] = _with("""
SELECT 'left_only' AS side, * FROM (SELECT CAST(invoice_id AS VARCHAR) AS invoice_id, CAST(customer_id AS VARCHAR) AS customer_id, in_credit FROM notices
    EXCEPT ALL SELECT CAST(invoice_id AS VARCHAR), CAST(customer_id AS VARCHAR), in_credit FROM notices_whatif) x
UNION ALL
SELECT 'right_only', * FROM (SELECT CAST(invoice_id AS VARCHAR), CAST(customer_id AS VARCHAR), in_credit FROM notices_whatif
    EXCEPT ALL SELECT CAST(invoice_id AS VARCHAR), CAST(customer_id AS VARCHAR), in_credit FROM notices) y""")
    q["table_diff_by_digest"] = q["table_diff"]
    q["medallion_roundtrip"] = q["flagged_accounts"]
    q["silver_notices"] = q["naive_notices"]
    q["silver_running_balance"] = q["running_balance"]
    # ---- tables that the stages wrote; positions are plain windows here
    q["silver_invoices"], q["silver_end_of_day"] = q["allocated_at_sent"], q["end_of_day_balance"]
    q["report_flags_by_rule"], q["report_severity_matrix"] = q["flags_by_rule"], q["severity_matrix"]
    q["report_flags_by_month"] = _with("""
SELECT month, flags, row_number() OVER (ORDER BY month) AS position
FROM (SELECT substr(flag_date, 1, 7) AS month, count(*) AS flags FROM flags GROUP BY 1) m""")
    q["report_flag_drilldown"] = _with(f"""
SELECT row_number() OVER (ORDER BY CASE f.severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END,
                                   f.customer_id, f.rule_id, f.flag_id, f.explanation) AS position,
       f.customer_id, f.rule_id, d.rule_label, f.severity, CAST(f.amount AS DOUBLE) AS amount,
       COALESCE(f.invoice_id, '') AS invoice_id, f.flag_date, f.explanation
FROM flags f JOIN {RULE_DIM} ON d.rule_id = f.rule_id""")
    q["flag_summary"] = _with("""
SELECT CASE WHEN GROUPING(month) = 0 THEN 'month' WHEN GROUPING(severity) = 0 THEN 'severity' ELSE 'rule' END AS report,
       rule_id, severity, month, count(*) AS flags
FROM (SELECT rule_id, severity, substr(flag_date, 1, 7) AS month FROM flags) f
GROUP BY GROUPING SETS ((rule_id), (month), (rule_id, severity))""")
    rows = {"bronze/customers": "customers", "bronze/ledger_entries": "ledger_entries", "bronze/invoices": "invoices",
            "bronze/invoice_allocations": "invoice_allocations", "silver/silver_running_balance": "valid",
            "silver/silver_end_of_day": "(SELECT DISTINCT customer_id, effective_date FROM valid) x", "silver/silver_invoices": "at_sent",
            "silver/silver_notices": "notices", "gold/flagged_accounts": "flags",
            "reports/flag_summary": "(SELECT DISTINCT rule_id, severity FROM flags UNION ALL SELECT DISTINCT rule_id, NULL FROM flags "
                                    "UNION ALL SELECT DISTINCT NULL, substr(flag_date, 1, 7) FROM flags) x",
            "reports/flags_by_rule": RULE_DIM, "reports/flags_by_month": "(SELECT DISTINCT substr(flag_date, 1, 7) FROM flags) x",
            "reports/severity_matrix": "(SELECT DISTINCT rule_id, severity FROM flags) x", "reports/flag_drilldown": "flags"}
    counts = [f"SELECT '{name}' AS table_name, 'rows' AS metric, count(*) AS value FROM {source}" for name, source in rows.items()]
    counts += [f"SELECT 'gold/flagged_accounts', 'rule_{r}', count(*) FILTER (WHERE rule_id = {r}) FROM flags" for r in range(1, 6)]
    q["stage_metrics"] = _with("\nUNION ALL ".join([*counts, "SELECT 'silver/silver_notices', 'in_credit', count(*) FILTER (WHERE in_credit) FROM notices"]))
    for name, plain in (("running_balance", "running_balance"), ("end_of_day", "end_of_day_balance"), ("continuity", "continuity_classes"),
                        ("rule3", "rule3_statement_gap"), ("rule5", "rule5_duplicate_invoice"), ("flagged_accounts", "flagged_accounts")):
        q[f"bucketed_{name}"] = q[plain]
    q["bronze_csv_roundtrip"] = q["bronze_csv_two_headers"] = q["billing_invoices"]
    return q
