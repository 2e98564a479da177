"""Readers of the raw tables."""

from merchlens.sources.csv_files import read_all, read_raw, read_split
from merchlens.sources.sample_tables import sample_specs, sample_tables, with_deliveries

__all__ = ["read_all", "read_raw", "read_split", "sample_specs", "sample_tables", "with_deliveries"]
