"""Streaming ingestion: normalized rows as they arrive, each prompt once. An extension: the batch
selection's priorities and quotas don't apply to a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import prompt_hash


def first_prompts(stream: DataFrame, language: str, prompt: str, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first row of each prompt. With an event time, state older than ``delay`` is let go."""
    hashed = stream.withColumn("prompt_hash", prompt_hash(F.col(language), F.col(prompt)))
    if event_time is None:
        return hashed.dropDuplicates(["prompt_hash"])
    return hashed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["prompt_hash"])


def event_counts(stream: DataFrame, time: str, kind: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows of each kind in tumbling windows."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("rows"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now as Parquet, exactly once, then stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
