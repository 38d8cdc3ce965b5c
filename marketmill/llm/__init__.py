"""Operators for training-data pipelines over text, each a Spark job."""
