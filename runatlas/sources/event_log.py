"""The append-only log of prediction events: folders of JSON lines, all fields as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.schemas import EVENT_COLUMNS, EVENT_LOG_SCHEMA


def publish(events: DataFrame, path: str) -> None:
    """Append events to the log. Nulls stay absent rather than turning into text."""
    texts = [F.col(c).cast("string").alias(c) for c in ("stream_entry_id", *EVENT_COLUMNS)]
    events.select(*texts).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_LOG_SCHEMA).json(path)


def stream_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The log as a stream, at most ``max_files`` new files per micro-batch."""
    reader = spark.readStream.schema(EVENT_LOG_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
