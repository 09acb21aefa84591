"""Spark operators and batch jobs for tabular business data and its models."""
