"""Operators of the ledger, on DataFrames."""
