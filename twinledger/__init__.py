"""Reconciliation of two independently extracted versions of the same nested, ordered records, on Spark."""
