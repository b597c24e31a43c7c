"""Structured Streaming forms of the stateful operators and of resumable jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def last_values(events: DataFrame, key: str, value: str, time: str) -> DataFrame:
    """Each key's last value by time, as a running aggregate for update or complete mode."""
    return events.groupBy(key).agg(F.max(F.struct(time, value)).alias("m"), F.count(value).alias("puts")).select(key, F.col(f"m.{value}").alias("value"), "puts")


def counts_by_window(events: DataFrame, time: str, by: str, length: str, late: str) -> DataFrame:
    """Counts in tumbling windows; rows later than the watermark are dropped, as windows are closed by it."""
    return events.withWatermark(time, late).groupBy(F.window(time, length), by).agg(F.count("*").alias("n"))


def process_available(spark: SparkSession, source: str, schema, process: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Runs process over files of source that no earlier call has processed, and ends; the checkpoint makes it exactly once."""
    rows = spark.readStream.schema(schema).parquet(source)
    return process(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
