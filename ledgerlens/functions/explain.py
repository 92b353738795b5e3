"""Deterministic explanation text per rule, rendered with ``concat_ws('')``.

A placeholder ``{name}`` is filled from the column of that name; a null value
renders as nothing (``concat_ws`` skips nulls).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The explanation sentence of each rule (text must match exactly).
# ---------------------------------------------------------------------------
TEMPLATES = {
    1: "Wrongful arrears notice: invoice {invoice_id} shown {shortfall} under-allocated at "
       "{sent_date} while account balance {balance} was in credit.",
    2: "Orphaned credit {entry_id}: {amount} unapplied for {days} days.",
    3: "Statement continuity break: {gap_days} day gap before invoice {invoice_id}.",
    4: "Dishonoured debit {entry_id} ({amount}) with no cause: balance {balance} pre-debit.",
    5: "Duplicate invoice {invoice_id} overlaps {other_invoice_id} with near-identical amount.",
}

_SLOT = re.compile(r"\{([a-z_]+)\}")


def explanation(rule_id: int, **values: Column) -> Column:
    """Fill the rule's template; every placeholder must be given as a Column."""
    parts: list[Column] = []
    pos = 0
    text = TEMPLATES[rule_id]
    for m in _SLOT.finditer(text):
        if m.start() > pos:
            parts.append(F.lit(text[pos:m.start()]))
        parts.append(values[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(text):
        parts.append(F.lit(text[pos:]))
    return F.concat_ws("", *parts)
