"""Equity-market analytics as Spark DataFrame transformations."""
