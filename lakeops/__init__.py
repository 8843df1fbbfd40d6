"""Retail data jobs on Spark DataFrames: clean, load, merge, aggregate, report."""
