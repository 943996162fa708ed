"""Composed jobs, and the catalogue of queries over the test tables."""
