"""Structured Streaming: event-time windows with watermarks, sessions, deduplication, and resumable batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_time(df: DataFrame) -> DataFrame:
    """events with `ts` as TIMESTAMP (watermarks don't take TIMESTAMP_NTZ)."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream over Parquet files of events as they appear."""
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return event_time(spark.readStream.schema(kinds).option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def windowed(events: DataFrame, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts and sums by event type over tumbling or sliding windows; with `late`, older events are dropped."""
    x = events.withWatermark("ts", late) if late else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return x.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """Per user the stretches of events with no pause of `gap`."""
    x = events.withWatermark("ts", late) if late else events
    return x.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def deduplicated(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hands all available input to each(batch, id); a rerun goes on after the last committed batch."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
