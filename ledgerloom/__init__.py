"""Ledger roll-forward, reconciliation and control analytics as Spark DataFrame jobs."""
