"""Postings analytics on Spark."""
