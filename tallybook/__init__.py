"""Ledger normalisation and entity matching over Spark DataFrames."""
