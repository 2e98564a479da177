"""Retail marketplace analytics as Spark DataFrame jobs."""
