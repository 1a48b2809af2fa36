"""Quern: evidence-first analytics operators for Spark DataFrames."""
