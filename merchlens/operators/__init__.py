"""Reusable operators: metrics, trailing periods, running totals, data checks."""
