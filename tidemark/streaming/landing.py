"""Landing raw messages by day and topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landing_rows(records: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Raw records as landing rows; the day comes from the record's own time."""
    return records.select("json_str", F.date_format(arrival, "yyyy-MM-dd").alias("dt"), "topic")


def land_raw_events(
    records: DataFrame,
    path: str,
    checkpoint: str,
    arrival: str = "arrival",
    trigger: str | None = None,
    max_records_per_file: int = 2_000_000,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Write records under ``dt=/topic=`` folders; a file is visible once its batch is committed.

    The file sink's commit log is the success marker: a reader of the folder lists committed
    files only. No shuffle by topic: a source task holds one topic's records already, so a topic
    with most of the traffic keeps all its tasks. Files roll by trigger and by record count.
    """
    writer = (
        landing_rows(records, arrival)
        .writeStream.format(file_format)
        .partitionBy("dt", "topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records_per_file)
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
