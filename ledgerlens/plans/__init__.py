"""Whole-table plans: Silver/Gold assembly, reports, validation, medallion stages."""
