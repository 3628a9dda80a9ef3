"""Residual-ledger analytics as PySpark DataFrame transformations."""
