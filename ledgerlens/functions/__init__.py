"""Column builders shared by the operators (all built-in Spark expressions)."""

from ledgerlens.functions.columns import iso_date, money, money_text, rule_dimension
from ledgerlens.functions.explain import TEMPLATES, explanation
from ledgerlens.functions.severity import severity_col, severity_rank_col

__all__ = [
    "iso_date", "money", "money_text", "rule_dimension", "TEMPLATES", "explanation",
    "severity_col", "severity_rank_col",
]
