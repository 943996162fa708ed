"""Bulletin analytics on PySpark: clean, segment, classify, score, dedupe, retrieve, archive."""
