"""Full refresh of a database table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows sent with one insert statement batch.
BATCH_ROWS = 10_000


def database_options(url: str, table: str, **connection: str) -> dict[str, str]:
    """Writer options: empty the table and its dependants, keep its definition, append."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "cascadeTruncate": "true",
        "batchsize": str(BATCH_ROWS),
        **connection,
    }


def write_database(frame: DataFrame, url: str, table: str, writers: int, **connection: str):
    """Replace the rows of a table, with as many connections as the database can take."""
    options = database_options(url, table, numPartitions=str(writers), **connection)
    frame.write.format("jdbc").mode("overwrite").options(**options).save()
