"""Yearring: row history, usage reports and a semantic layer on Spark."""
