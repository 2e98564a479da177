"""Named queries over the sample tables, and the SQL that checks them."""

from merchlens.registry.oracle import oracle_sql
from merchlens.registry.queries import queries

__all__ = ["oracle_sql", "queries"]
