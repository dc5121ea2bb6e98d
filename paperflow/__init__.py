"""Spark jobs that keep a large scientific-paper corpus curated."""
