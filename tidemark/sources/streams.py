"""Streaming sources: Kafka topics in production, files of raw rows elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(
    servers: str,
    topics: str | None = None,
    pattern: str | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of Spark's Kafka source for a topic list or a topic pattern. Offsets that are gone end the
    stream with an error, unless ``fail_on_data_loss`` is given as false."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "subscribe" if topics else "subscribePattern": topics or pattern,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_raw(spark: SparkSession, **options: str) -> DataFrame:
    """Kafka records as raw rows: json_str, topic, arrival (the record's timestamp)."""
    records = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return records.select(
        F.col("value").cast("string").alias("json_str"),
        "topic",
        F.col("timestamp").alias("arrival"),
    )


def parse_messages(
    raw: DataFrame, schema: T.StructType | str, source: str = "json_str", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Typed columns of JSON messages; missing fields are null, unparsable messages are dropped.

    A message counts as unparsable when nothing of it could be read.
    """
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    doc = F.from_json(F.col(source), parsed, {"mode": "PERMISSIVE"})
    # ``inline`` keeps later filters above the parse, so a message is parsed once.
    rows = raw.select(*carry, F.inline(F.array(F.struct(doc.alias("doc"))))).select(*carry, "doc.*")
    return rows.dropna("all", subset=[field.name for field in parsed.fields])


def with_event_time(
    df: DataFrame, ms: str = "server_ts", delay: str = "5 seconds", name: str = "event_time"
) -> DataFrame:
    """Event time from epoch milliseconds; streams drop rows later than ``delay``."""
    timed = df.withColumn(name, F.timestamp_millis(F.col(ms)))
    return timed.withWatermark(name, delay) if df.isStreaming else timed
