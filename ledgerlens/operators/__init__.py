"""Silver and Gold operators over the four billing tables."""

from ledgerlens.operators import allocations, intervals, ledger, notices, rules

__all__ = ["allocations", "intervals", "ledger", "notices", "rules"]
