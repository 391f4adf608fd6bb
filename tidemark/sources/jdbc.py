"""Buffered writes to a JDBC table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, driver: str | None = None, batch_rows: int = 5000, connections: int = 16, **more: str
) -> dict[str, str]:
    """Write options: rows per round trip, and an upper bound on parallel connections."""
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **more,
    }
    if driver:
        options["driver"] = driver
    return options


def jdbc_write(df: DataFrame, **options: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(**options)).mode("append").save()


def jdbc_sink(**options: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function; the target keeps the newest version per key, so a replayed
    batch is harmless. The trigger interval takes the place of a flush interval."""

    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc_write(batch, **options)

    return write
