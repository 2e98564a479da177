"""Writers: typed warehouse tables, landing files, a relational database."""

from merchlens.sinks.landing import land_csv
from merchlens.sinks.relational import database_options, write_database
from merchlens.sinks.warehouse import ConstraintError, Warehouse

__all__ = ["ConstraintError", "Warehouse", "database_options", "land_csv", "write_database"]
