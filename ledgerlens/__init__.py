"""ledgerlens: billing-reconciliation anomaly detection as lazy Spark DataFrame plans.

The ledger (running balance) is the source of truth; the per-invoice allocation
layer may be wrong.  Anomalies are the places where the two disagree.

Layout
------
params      DetectorParams and the fixed severity/label values
schemas     StructTypes of the four billing tables and the Gold output
session     session helpers (checkpoint folder read from the session)
sources/    readers (CSV/parquet/in-memory), upstream checks, test-table mapping
functions/  column builders: severity, explanations, ISO dates, money
operators/  ledger, allocation, notice, interval and rule operators
plans/      Gold assembly, reports, validation, medallion stages
streaming/  incremental (availableNow) Bronze ingest of new ledger files
"""

from ledgerlens.params import DetectorParams

__all__ = ["DetectorParams"]
__version__ = "0.1.0"
