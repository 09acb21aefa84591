"""Batch jobs, the views over the given tables, and the query catalogue."""
