"""Retail receipt analytics on Spark: windowed spend, enrichment, upserted tables, reports."""
