"""Starting streaming queries: triggers, checkpoints, micro-batch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = None,
    mode: str = "update",
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``sink``.

    ``trigger`` is the refresh interval; without it the query works off what is there and stops.
    The sink is called again with the same batch id after a failure and must replace its output.
    """
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for bounded queries; a failure of one is raised."""
    for query in queries:
        query.awaitTermination()


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several sinks fed by one query: the batch is computed once and kept while they write."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return write
