"""Retail analytics on Spark: ingest, conform, marts, segments and audits as DataFrame functions."""
