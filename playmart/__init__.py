"""Listening analytics on Spark: ingest, enrichment, star schema and reports.

Every operator takes and returns lazy DataFrames, so Catalyst sees whole pipelines.
"""
