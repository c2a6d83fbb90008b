"""Retail analytics on Spark: ingest, profile, clean, enrich, aggregate and forecast sales data."""
