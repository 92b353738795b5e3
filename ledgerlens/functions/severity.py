"""Severity escalation as a column expression.

Only rules whose money at risk is well defined escalate: rule 1 on the notice's
shortfall, rule 5 on the duplicate's amount.  The others keep their base severity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.params import SEVERITY_RANK, DetectorParams, escalation


def severity_col(rule_id: int, money_at_risk: Column | None, params: DetectorParams) -> Column:
    base, limit, escalated = escalation(rule_id, params)
    if limit is None or money_at_risk is None:
        return F.lit(base)
    return F.when(money_at_risk > F.lit(limit), F.lit(escalated)).otherwise(F.lit(base))


def severity_rank_col(c: Column | str) -> Column:
    """Urgency rank of a severity (0 = critical), for sorting."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for name, rank in SEVERITY_RANK.items():
        expr = (F.when(col == name, F.lit(rank)) if expr is None else expr.when(col == name, F.lit(rank)))
    return expr.otherwise(F.lit(len(SEVERITY_RANK)))
