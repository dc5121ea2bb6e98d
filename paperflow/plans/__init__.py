"""Whole workloads, and the queries over the given tables."""
