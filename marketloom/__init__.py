"""Layered commerce analytics (raw, staging, warehouse, marts) as Spark DataFrame jobs."""
