"""The raw landing zone: JSON text partitioned by day and topic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SCHEMA = "json_str string, dt string, topic string"

# The source topics.
ENTITY_TOPICS = ("app_user_profile", "app_video_content", "app_comment")
EVENT_TOPICS = (
    "app_event_account",
    "app_event_video",
    "app_event_social",
    "app_event_comment",
    "app_event_vip",
)
TOPIC_PATTERN = "app_.*"


def read_raw(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The landing folder; its schema is given, so no file is opened to infer it."""
    return spark.read.schema(RAW_SCHEMA).format(file_format).load(path)


def scan_raw(raw: DataFrame, topic: str, dt: str | Iterable[str] | None = None) -> DataFrame:
    """Rows of one topic and of one day, several days or all days.

    Both conditions compare partition columns with literals, so only those folders are listed.
    """
    rows = raw.where(F.col("topic") == topic)
    if dt is None:
        return rows
    days = [dt] if isinstance(dt, str) else list(dt)
    return rows.where(F.col("dt").isin(*days))
